"""Small landed feed files for the end-to-end tests."""

from __future__ import annotations

import csv
import gzip
import json
import pathlib


def put(root: pathlib.Path, name: str, text: str) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def score_file(root, day, rows, *, model=None, percentile=True, folder="2024"):
    lines = []
    if model:
        lines.append(f"#model_version:{model},score_date:{day}T00:00:00+0000")
    lines.append("cve,epss,percentile" if percentile else "cve,epss")
    lines += [",".join(map(str, row)) for row in rows]
    path = root / folder / f"epss_scores-{day}.csv.gz"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))


def score_lines(root, day, lines):
    path = root / "2024" / f"epss_scores-{day}.csv.gz"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))


def record(root, cve, updated, *, title="t", adp=None, broken=False):
    body = {
        "cveMetadata": {"cveId": cve, "state": "PUBLISHED", "dateUpdated": updated},
        "containers": {"cna": {"title": title}, "adp": adp or []},
    }
    text = "{" if broken else json.dumps(body)
    put(root, f"cves/{cve.split('-')[1]}/{cve}.json", text)


def advisory(root, ghsa, modified, *, folder="github-reviewed", **fields):
    body = {"id": ghsa, "modified": modified, "published": modified, **fields}
    put(root, f"db/advisories/{folder}/2024/{ghsa}.json", json.dumps(body))


EXPLOIT_COLUMNS = (
    "id", "file", "description", "date_published", "author", "type", "platform", "port",
    "date_added", "date_updated", "verified", "codes", "tags", "aliases",
    "screenshot_url", "application_url", "source_url",
)


def exploit_index(root, rows):
    root.mkdir(parents=True, exist_ok=True)
    with (root / "index.csv").open("w", newline="") as out:
        writer = csv.DictWriter(out, EXPLOIT_COLUMNS)
        writer.writeheader()
        for row in rows:
            writer.writerow({c: row.get(c, "") for c in EXPLOIT_COLUMNS})


def template(root, path, template_id, *, name="n", signature="s1"):
    put(
        root,
        f"top/{path}",
        f"id: {template_id}\ninfo:\n  name: {name}\nhttp: []\n# digest: {signature}\n",
    )


def exploited(root, entries):
    put(root, "catalog.json", json.dumps({"vulnerabilities": entries}))


def weaknesses(root, version, day, names):
    body = "".join(
        f'<Weakness ID="{i}" Name="{n}" Abstraction="Base" Status="Draft">'
        f"<Description>About {n}</Description></Weakness>"
        for i, n in names.items()
    )
    put(
        root,
        f"cwec_{version}.xml",
        f'<?xml version="1.0"?><Weakness_Catalog xmlns="http://cwe.mitre.org/cwe-7" '
        f'Version="{version}" Date="{day}"><Weaknesses>{body}</Weaknesses>'
        "</Weakness_Catalog>",
    )


def bundle(root, name, objects):
    put(root, name, json.dumps({"type": "bundle", "objects": objects}))


def change_page(root, name, text, *, title="T", day="2026-01-02"):
    put(
        root,
        f"src/content/changelog/waf/{name}.mdx",
        f'---\ntitle: "{title}"\ndate: {day}\n---\n\n{text}\n',
    )
