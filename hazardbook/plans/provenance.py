"""Where every dataset comes from and under which terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = (
    "name", "source_url", "license_name", "license_text", "attribution", "disclaimer",
)

# Provenance of the ten datasets, as their licenses ask for.
DATASETS = (
    (
        "epss",
        "https://www.first.org/epss/data_stats",
        "FIRST EPSS Usage Agreement (LicenseRef-scancode-first-epss-usage)",
        '"We grant the use of EPSS scores freely to the public, subject to the following conditions. ... we ask that if you are using EPSS, that you provide appropriate attribution where possible." — https://www.first.org/epss/faq',
        "EPSS scores provided by FIRST.org — https://www.first.org/epss. Citation: Jay Jacobs, Sasha Romanosky, Benjamin Edwards, Michael Roytman, Idris Adjerid (2021), Exploit Prediction Scoring System, Digital Threats Research and Practice, 2(3).",
        "This project redistributes EPSS data but is not endorsed or certified by FIRST.",
    ),
    (
        "cve",
        "https://github.com/CVEProject/cvelistV5",
        "CVE Terms of Use (cve-tou)",
        '"CVE Usage: MITRE hereby grants you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare derivative works of, publicly display, publicly perform, sublicense, and distribute Common Vulnerabilities and Exposures (CVE®). Any copy you make for such purposes is authorized provided that you reproduce MITRE\'s copyright designation and this license in any such copy." — https://www.cve.org/Legal/TermsOfUse',
        "CVE® is a registered trademark of The MITRE Corporation. CVE Records: Copyright © 1999-2026 The MITRE Corporation.",
        "This project redistributes CVE Records but is not endorsed or certified by MITRE or the CVE Program.",
    ),
    (
        "ghsa",
        "https://github.com/github/advisory-database",
        "CC-BY 4.0",
        "Creative Commons Attribution 4.0 International (https://creativecommons.org/licenses/by/4.0/). This dataset is a modified form of the GitHub Advisory Database: OSV-format JSON records converted to Parquet with extracted columns.",
        "GitHub Advisory Database — © GitHub, Inc. (https://github.com/github/advisory-database), licensed under CC-BY 4.0.",
        "This project redistributes GitHub Advisory Database records but is not endorsed or certified by GitHub, Inc.",
    ),
    (
        "exploitdb",
        "https://gitlab.com/exploit-database/exploitdb",
        "GPL-2.0-or-later",
        "GNU General Public License v2.0 or later (https://www.gnu.org/licenses/old-licenses/gpl-2.0.html). This dataset is a modified form of the Exploit Database index (files_exploits.csv): CSV metadata converted to Parquet with extracted columns. Exploit code is not redistributed; each row links to it via code_url. Source of the redistributed data: https://gitlab.com/exploit-database/exploitdb/-/raw/main/files_exploits.csv",
        "Exploit Database (https://gitlab.com/exploit-database/exploitdb), maintained by OffSec, licensed under GPL-2.0-or-later.",
        "This project redistributes the Exploit Database index but is not endorsed or certified by OffSec.",
    ),
    (
        "nuclei",
        "https://github.com/projectdiscovery/nuclei-templates",
        "MIT",
        "MIT License (https://opensource.org/license/mit). This dataset is a modified form of the nuclei-templates repository: template info-block metadata extracted from YAML and converted to Parquet. Template bodies (matchers/payloads) are not redistributed; each row links to the template via template_url.",
        "nuclei-templates — © ProjectDiscovery, Inc. (https://github.com/projectdiscovery/nuclei-templates), licensed under the MIT License.",
        "This project redistributes nuclei-templates metadata but is not endorsed or certified by ProjectDiscovery, Inc.",
    ),
    (
        "cwe",
        "https://cwe.mitre.org/data/downloads.html",
        "CWE Terms of Use",
        "CWE Terms of Use (https://cwe.mitre.org/about/termsofuse.html). Free to use, copy and redistribute with attribution. This dataset is a modified form of the cwec XML catalog: weaknesses, categories and views converted to Parquet with selected fields.",
        "CWE — Common Weakness Enumeration, © The MITRE Corporation (https://cwe.mitre.org/).",
        "This project redistributes CWE content but is not endorsed or certified by The MITRE Corporation.",
    ),
    (
        "kev",
        "https://www.cisa.gov/known-exploited-vulnerabilities-catalog",
        "CC0-1.0",
        "Creative Commons Zero 1.0 Universal (https://creativecommons.org/publicdomain/zero/1.0/). The KEV database is distributed by CISA under CC0 1.0 (https://www.cisa.gov/sites/default/files/licenses/kev/license.txt). This dataset is a modified form of the KEV catalog JSON converted to Parquet. Information at third-party links included in the KEV data is bound by the policies and licenses of those third-party websites.",
        "Known Exploited Vulnerabilities Catalog — CISA (https://www.cisa.gov/known-exploited-vulnerabilities-catalog), distributed under CC0 1.0 Universal.",
        "This project redistributes KEV catalog data but is not endorsed by CISA or DHS, and does not use the CISA Logo or DHS Seal.",
    ),
    (
        "cloudflare_waf",
        "https://github.com/cloudflare/cloudflare-docs",
        "CC-BY-4.0",
        "Creative Commons Attribution 4.0 International (https://creativecommons.org/licenses/by/4.0/). This dataset is a modified form of Cloudflare Docs WAF ChangeLog MDX: vulnerability identifiers are extracted and converted to Parquet.",
        "Cloudflare Docs WAF ChangeLog — Cloudflare (https://developers.cloudflare.com/waf/change-log/), licensed under CC-BY 4.0.",
        "This project redistributes derived Cloudflare Docs metadata but is not endorsed or certified by Cloudflare.",
    ),
    (
        "attack",
        "https://github.com/mitre-attack/attack-stix-data",
        "MITRE ATT&CK Terms of Use",
        "MITRE grants a non-exclusive, royalty-free license to use ATT&CK for research, development, and commercial purposes, provided copies reproduce MITRE's copyright designation and license. This dataset is a modified form of the Enterprise, Mobile, and ICS ATT&CK STIX bundles converted to Parquet.",
        "ATT&CK® — © 2026 The MITRE Corporation. This work is reproduced and distributed with the permission of The MITRE Corporation.",
        "This project redistributes ATT&CK content but is not endorsed or certified by The MITRE Corporation.",
    ),
    (
        "capec",
        "https://github.com/mitre/cti/tree/master/capec/2.1",
        "MITRE CAPEC Terms of Use",
        "MITRE grants a non-exclusive, royalty-free license to use CAPEC for research, development, and commercial purposes, provided copies reproduce MITRE's copyright designation and license. This dataset is a modified form of the CAPEC STIX bundle converted to Parquet.",
        "CAPEC™ — © The MITRE Corporation (https://capec.mitre.org/).",
        "This project redistributes CAPEC content but is not endorsed or certified by The MITRE Corporation.",
    ),
)


def datasets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DATASETS, ", ".join(f"{c} string" for c in COLUMNS))
