"""The operators on small tables: nulls, empty and long texts, ties, repeats, no rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardbook.llm import (
    edit_embedding, histogram_sort, language_spans, mixing, personal_data, rule_ensemble,
    set_join, templates, transcripts, url_tree,
)
from hazardbook.llm.common import held_out
from hazardbook.llm.queries import RULES

LONG = "lorem ipsum dolor sit amet " * 20_000


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(None, None, None, None), (1, None, None, "a"), (2, "", "en", None), (3, " \t\n", "en", "a"), (4, LONG, "en", "a")]


# op3


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute_components(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs_of, width, percent):
    rng = random.Random(width)
    rows = [(1, ""), (2, None), (3, "Two words"), (4, "two WORDS"), (5, "one"), (6, " ")]
    for n in (6, 12, 40, 150, 600):
        base = words(rng, n).split()
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, n // 15))):
                copy[rng.randrange(n)] = f"x{rng.randrange(9)}"
            rows.append((len(rows) + 1, " ".join(copy)))
    got = set_join.jaccard_components(docs_of(rows), "doc_id", "text", width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, width, percent)


def test_components_of_odd_rows(docs_of):
    got = set_join.jaccard_components(docs_of([*ODD, (4, LONG), (9, LONG), (None, LONG)]), "doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [
        (0, 0), (0, 4), (1, 1), (2, 2), (3, 3), (4, 4), (4, 4), (9, 4)]
    assert set_join.jaccard_components(docs_of([]), "doc_id", "text").count() == 0
    kept = set_join.without_duplicates(docs_of([*ODD, (4, LONG), (9, LONG)]), "doc_id", "text")
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4]


# op4


def test_shards_follow_exact_bytes(docs_of):
    rng = random.Random(4)
    rows = [(rng.choice([i, 7, -(2**63), 2**63 - 1]) if i % 5 else i, f"{i} " + "a" * rng.randrange(90)) for i in range(300)]
    dealt = histogram_sort.histogram_shards(docs_of([*rows, (None, None)]), "doc_id", F.length(F.coalesce("text", F.lit(""))) + 16, ["text"], 8)
    got = dealt.collect()
    assert len(got) == 301
    assert set(dealt.columns) == {"doc_id", "text", "lang", "source", "n_chars", "size", "label", "shard", "slot"}
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    key = lambda r: -(2**64) if r["doc_id"] is None else r["doc_id"]
    for shard in by.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
        ordered = sorted(shard, key=lambda r: r["slot"])
        assert [key(r) for r in ordered] == sorted(key(r) for r in shard)
    sizes = [sum(len(r["text"] or "") + 16 for r in s) for s in by.values()]
    assert len(by) == 8 and max(sizes) - min(sizes) <= 2 * 110
    assert histogram_sort.histogram_shards(docs_of([]), "doc_id", F.lit(1), ["text"], 8).count() == 0


# op5


def test_url_rules_and_templates(spark):
    urls = [None, "", "no scheme", "https://a.EXAMPLE.org/es/1?x#y", "http://example.org/en/17", "http://x.example.org/en/27",
            "http://org/", "ftp://b.com/de/5", "http://b.com/fr/5#z", "http://c.net/de/9", "http://com.evil/fr/1", "http://h://p"]
    pages = spark.createDataFrame([(i, u, "host", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, n int")
    got = {r["page_id"]: r for r in url_tree.judge(pages, "url", ["page_id"], RULES).collect()}
    assert [got[i]["rule"] for i in range(len(urls))] == [
        None, None, None, "example.org/es/", "example.org/en/1", "org/", "org/", "com/de/", "com/fr/", None, None, None]
    assert (got[0]["host"], got[0]["path"]) == ("", "") and got[2]["host"] == ""
    assert (got[3]["host"], got[3]["path"]) == ("a.example.org", "/es/1")
    assert (got[11]["host"], got[11]["path"]) == ("h:", "//p")
    assert {r["verdict"] for r in got.values()} <= {"allow", "block"}
    assert got[3]["verdict"] == "block" and got[8]["verdict"] == "allow"
    assert url_tree.judge(pages.where("false"), "url", ["page_id"], RULES).count() == 0


def test_templates_learn_from_labels(spark):
    rows = [(i, f"http://s{i % 3}.com/de/{i}") for i in range(60)] + [(60 + i, f"http://s.net/de/{i}") for i in range(5)]
    rows += [(100 + i, f"http://s.net/en/{i}") for i in range(5)] + [(200 + i, f"http://q.org/en/a{i}") for i in range(60)]
    got = url_tree.judge(spark.createDataFrame(rows, "page_id long, url string"), "url", ["page_id"], RULES).collect()
    verdicts = {(r["host"], r["template"]): r["verdict"] for r in got if r["rule"] is None}
    assert verdicts == {("s.net", "/de/*"): "block", ("s.net", "/en/*"): "allow"}


def test_templates_without_labels_link_no_others(spark):
    rows = [(i, f"http://s{i % 3}.com/de/{i}") for i in range(60)] + [(60 + i, f"http://s.net/{x}/{i}") for i in range(5) for x in ("de", "en", "blog")]
    rows += [(200 + i, f"http://q.org/en/a{i}") for i in range(60)]
    got = url_tree.judge(spark.createDataFrame(rows, "page_id long, url string"), "url", ["page_id"], RULES).collect()
    purity = {r["template"]: r["purity"] for r in got if r["host"] == "s.net"}
    assert purity["/de/*"] > 0.9 and purity["/en/*"] < 0.1 and 0.4 < purity["/blog/*"] < 0.6


def test_templates_of_many_equal_sections_slugs_and_deep_paths(spark):
    letters = [a + b for a in "bcdfghkl" for b in "abcdefgh"][:60]
    urls = [f"http://x.net/{s}/{i}" for s in letters for i in range(5)] + [f"http://x.net/de/{i}" for i in range(5)]
    urls += [f"http://s{i % 3}.com/de/{i}" for i in range(60)] + [f"http://q.org/en/a{i}" for i in range(60)]
    urls += [f"http://y.net/blog/{s}" for s in letters[:20]]
    urls += [f"http://z.net/a/b/c/d/e/{s}/{i}" for s in ("f", "g") for i in range(5)] + ["http://z.net/a/b/c/d/e/h/i/j"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_tree.judge(pages, "url", ["page_id"], RULES).collect()
    assert len(got) == len(urls)
    verdicts = {(r["host"], r["template"]): r["verdict"] for r in got}
    assert verdicts["x.net", "/de/*"] == "block"
    assert {t for h, t in verdicts if h == "x.net"} == {f"/{s}/*" for s in [*letters, "de"]}
    assert {t for h, t in verdicts if h == "y.net"} == {"/blog/*"}
    assert {t for h, t in verdicts if h == "z.net"} == {"/a/b/c/d/e/f/*", "/a/b/c/d/e/g/*", "/a/b/c/d/e/*/*/*"}


# op7


def test_mix_meets_targets(docs_of):
    rng = random.Random(7)
    rows = [(i, words(rng, rng.randrange(1, 30)), "en", rng.choice(["a", "b", "c", "d", None])) for i in range(800)]
    plan = mixing.mix_plan(docs_of([*rows, *ODD[1:4]]), "doc_id", "text", "source").collect()
    by = {}
    for r in plan:
        taken = by.setdefault((r["source_size"], r["target"]), [0, 0])
        taken[0] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    assert len(by) == 5
    total = sum(size for size, _ in by)
    assert sum(t for _, t in by) == pytest.approx(total)
    for (_, target), (taken, _) in by.items():
        assert abs(taken - target) <= 30
    mixed = mixing.mixed(docs_of(rows), "doc_id", "text", "source")
    assert mixed.columns == docs_of(rows).columns
    assert mixing.mix_plan(docs_of([]), "doc_id", "text", "source").count() == 0


def test_mix_stops_at_cap(docs_of):
    rows = [(1, "one", None, "a")] + [(i, "x " * 9, None, "b") for i in range(2, 30)]
    got = {r["doc_id"]: r for r in mixing.mix_plan(docs_of(rows), "doc_id", "text", "source").collect()}
    assert got[1]["target"] == 3 and got[1]["copies"] == 3


# op8


def test_languages(docs_of):
    rng = random.Random(8)
    bags = {"en": "the and with that from this".split(), "fr": "le les dans avec que été".split(), "ru": "это был она что как".split()}
    rows = [(i, " ".join(rng.choices(bags[lang], k=30)), lang) for i, lang in enumerate(["en", "fr", "ru"] * 40)]
    docs = docs_of(rows)
    model = language_spans.learn(docs.where(~held_out()), "doc_id", "text", "lang")
    got = {r["doc_id"]: r for r in language_spans.identify(docs, "doc_id", "text", model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    mixed = "the and with that " * 20 + "это был она что " * 8
    odd = language_spans.identify(docs_of([*ODD, (5, mixed), (6, "123 !")]), "doc_id", "text", model).collect()
    found = {r["doc_id"]: r for r in odd}
    assert [found[i]["lang_pred"] for i in (None, 1, 2, 3, 6)] == ["und"] * 5
    assert [s["lang"] for s in found[5]["spans"]] == ["en", "ru"] and found[5]["lang_pred"] == "en"
    assert found[5]["spans"][1]["start"] == mixed.index("это")
    kept = language_spans.identified(docs_of([*ODD, (5, mixed)]), "text", model)
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]
    nothing = language_spans.learn(docs_of([]), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language_spans.identify(docs, "doc_id", "text", nothing).collect()} == {"und"}
    assert language_spans.identify(docs_of([]), "doc_id", "text", model).count() == 0


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    from itertools import product

    for n in (1, 2, 5):
        scores = rng.normal(size=(n, 3)).astype(np.float32)
        value = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
        best = max(product(range(3), repeat=n), key=value)
        assert tuple(language_spans.best_paths(scores, np.array([n]), 0.7)) == best


# op9


def test_templates_find_copies_and_new_parameters(spark, docs_of):
    item = "How many apples does Anna Smith have if she buys 12 kg and gives 5 apples to Bob and 12 pears to nobody else"
    other = item.replace("Anna Smith", "Maria").replace("12", "40").replace("5", "8").replace("Bob", "Tim")
    clash = item.replace("and 12 pears", "and 77 pears")
    rows = [(1, "before. " + item + " after"), (2, "Say: " + other), (3, clash), (4, "nothing of that kind at all"), (5, item), (5, item), *ODD]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short Item 3")], "item_id long, text string")
    found = templates.contaminated(docs_of(rows), items, "doc_id", "text").collect()
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in found}
    assert got[1, 1] is False and got[2, 1] is True and got[5, 1] is False
    assert (3, 1) not in got and (4, 1) not in got and {i for _, i in got} == {1}
    kept = templates.decontaminated(docs_of(rows), items, "doc_id", "text")
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 3, 4, 4]
    assert templates.contaminated(docs_of([]), items, "doc_id", "text").count() == 0
    assert templates.contaminated(docs_of(rows), items.where("false"), "doc_id", "text").count() == 0


def test_templates_find_changed_and_partial_copies(spark, docs_of):
    rng = random.Random(9)
    plain = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('klmnp')}{i:x}".translate(str.maketrans("0123456789", "qrstuvwxyz")) for i in range(500)]
    long, huge = " ".join(plain[:59]), " ".join(plain)
    repeated = " ".join([*plain[:10], "12", *plain[10:18], "12", *plain[18:28]])
    two = " ".join([*plain[200:206], "5", *plain[206:212], "7", *plain[212:218]])
    items = spark.createDataFrame([(1, long), (2, huge), (3, repeated), (4, two), (5, "add 5")], "item_id long, text string")
    rows = [(1, "so " + " ".join(plain[20:45]) + " on"), (2, "so " + " ".join(plain[250:450]) + " on"), (3, repeated[::-1].replace("21", "77", 1)[::-1]),
            (4, two.replace("5", "4").replace("7", "4")), (5, "we add 6 of them"), (6, "we add 5 of them"), (7, " ".join(plain[20:30]))]
    found = templates.contaminated(docs_of(rows), items, "doc_id", "text").collect()
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in found}
    assert got == {(1, 1): False, (1, 2): False, (2, 2): False, (3, 3): True, (4, 4): True, (6, 5): False}


# op1


def test_fingerprints_follow_edit_distance(docs_of):
    rng = random.Random(1)
    texts = [words(rng, n, 5000) for n in (1, 30, 300, 3000)]
    near = [t.replace("w1", "v", 3) for t in texts]
    prints = edit_embedding.embed([*texts, *near, "", "x"])
    for i in (2, 3):
        assert (prints[i] == prints[i + 4]).mean() > 0.7
        assert (prints[i] == prints[i - 1]).mean() < 0.1
    assert not prints[8].any() and (edit_embedding.embed([texts[2]])[0] == prints[2]).all()
    rows = [*ODD, (7, texts[2]), (7, texts[3]), (8, texts[2]), (8, texts[2])]
    got = edit_embedding.against_next(docs_of(rows), "doc_id", "text").collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["edited_sha256"] == hashlib.sha256(b"").hexdigest() and by[2]["near_next"] == 0 and by[1]["near_next"] == 1
    k = len(LONG) // 4
    assert by[4]["n_chars"] == len(LONG) and by[4]["near_edited"] > 0.5
    assert by[4]["edited_sha256"] in {hashlib.sha256((LONG[:-k] + t[:k]).encode()).hexdigest() for t in texts[2:]}
    assert edit_embedding.against_next(docs_of([]), "doc_id", "text").count() == 0
    links = edit_embedding.near_links(edit_embedding.fingerprints(docs_of([(1, texts[3]), (2, near[3]), (3, texts[2]), (4, texts[3]), (5, edit_embedding.edited(texts[3], texts[2]))]), "doc_id", "text"), 0.5)
    assert sorted((r["a"], r["b"]) for r in links.collect()) == [(1, 2), (1, 4), (1, 5)]


# op2


def test_transcripts_give_the_turns_back(spark):
    turns = [(1, 0, "system", "Be brief.\nAlways."), (1, 1, "user", "Why?\n\nTell me"), (1, 2, "assistant", "Because"), (2, 0, "user", None),
             (2, 1, "assistant", ""), (2, 70, "user", "Note: later"), (None, 0, "user", "x"), (3, None, "assistant", "y")]
    cut = transcripts.pieces(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    got = transcripts.parse(cut, transcripts.learn(cut)).collect()
    assert sorted((r["conv_id"] or 0, r["piece"], r["turn"], r["rendered"]) for r in got) == sorted(
        (c or 0, (t or 0) // 64, (t or 0) % 64 if t != 70 else 0, transcripts.rendered(role, text or "")) for c, t, role, text in turns
    )
    empty = cut.where("false")
    assert transcripts.learn(empty) is None and transcripts.parse(empty, None).count() == 0
    assert {r["role"] for r in transcripts.parse(cut, None).collect()} == {"unknown"}


# op6


def test_rules_learn_and_compile(spark, docs_of):
    rng = random.Random(6)
    good = [(i, ". ".join(words(rng, 12) for _ in range(4))) for i in range(200)]
    bad = [(200 + i, "SPAM!! " * 40) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = rule_ensemble.scored(docs_of([*good, *bad, *ODD]), labels, "doc_id", "text", "quality", held_out()).collect()
    assert len(got) == 405 and all(0 <= r["score"] <= 1 for r in got)
    known = [r for r in got if r["doc_id"] is not None and 5 <= r["doc_id"]]
    assert all((r["score"] >= 0.5) == (r["doc_id"] < 200) for r in known)
    none = rule_ensemble.scored(docs_of(good), labels.where("false"), "doc_id", "text", "quality", held_out()).collect()
    assert {r["score"] for r in none} == {0.5}
    assert rule_ensemble.scored(docs_of([]), labels, "doc_id", "text", "quality", held_out()).count() == 0


def test_paths_of_a_printed_tree():
    tree = "If (feature 0 <= 1.5)\n If (feature 1 <= 2.0)\n  Predict: 0\n Else (feature 1 > 2.0)\n  Predict: 1\nElse (feature 0 > 1.5)\n Predict: 0"
    assert rule_ensemble.paths(tree, ["a", "b"]) == [
        (("a", True, 1.5),), (("a", True, 1.5), ("b", True, 2.0)), (("a", True, 1.5), ("b", False, 2.0)), (("a", False, 1.5),)]


# op10

PATTERNS = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [c for c in m[0] if c.isdigit()]
            good = {0: True, 1: kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                    2: 12 <= len(digits) <= 19 and personal_data.luhn("".join(digits) or "0"), 3: 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(10)
    parts = ["a.b@c.de", "@", "1.2.3.4", "300.1.1.1", ".", "4111111111111111", "4111-1111 1111 1111", "+1 (988) 555-2485", "+", "7", " ", "x", "-", "é", "a@b", "1.2.3.4.5.6.7.8.9"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert personal_data.base_spans(text) == plain_spans(text), text


def test_personal_data_adds_spellings(docs_of):
    text = "é call me at (212) 555-0188 or jane.roe@mail.example.com, ip 10.0.0.7, in 2019 we had 350 people"
    rows = [(7, text), *ODD[:4], (8, "1" * 60_000 + " " + "a" * 60_000 + "@")]
    got = {r["doc_id"]: r for r in personal_data.find(docs_of(rows), "doc_id", "text").collect()}
    kinds = {s.split(":")[0]: text[slice(*map(int, s.split(":")[1:]))] for s in got[7]["spans"].split(",")}
    assert kinds == {"phone": "(212) 555-0188", "email": "jane.roe@mail.example.com", "ip": "10.0.0.7"}
    assert (got[7]["n_email"], got[7]["n_ip"], got[7]["n_phone"]) == (1, 1, 0)
    assert all(got[i]["spans"] == "" for i in (None, 1, 2, 3, 8))
    assert personal_data.find(docs_of([]), "doc_id", "text").count() == 0


# op3, sketches


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_bound_the_distance_from_below(percent):
    rng = np.random.default_rng(percent)
    for n in (1, 3, 30, 300, 3000):
        for cut in (0, 1, n // 20, n // 5, n // 2):
            a = np.unique(rng.integers(0, 2**64, n, np.uint64))
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**64, cut // 2, np.uint64)]))
            if not len(b):
                continue
            x, y = (np.unpackbits(set_join.sketch(s, percent).view(np.uint8), bitorder="little") for s in (a, b))
            while len(x) != len(y):
                if len(x) > len(y):
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                else:
                    y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            apart = len(np.setxor1d(a, b))
            assert (x != y).sum() <= apart and (x != y).sum() % 2 == apart % 2


# op2, hot conversations


def test_pieces_stay_bounded_when_numbers_repeat(spark):
    rows = [(None, None, "user", f"a {i}") for i in range(4000)] + [(7, 3, None, "same")] * 3000 + [(8, i, "assistant", f"b {i}") for i in range(200)]
    rows += [(8, 5, None, "B 5"), (None, 1, None, "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("clash"))
    cut = transcripts.pieces(turns, "conv_id", "turn", "role", "text")
    assert cut.columns == ["conv_id", "piece", "turns"]
    sizes = cut.select("conv_id", "piece", F.size("turns").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == len(rows) and max(r["n"] for r in sizes) <= 2 * transcripts.PIECE
    ordered = cut.where("conv_id = 8").orderBy("piece").select("piece", "turns.turn").collect()
    assert [r["turn"][0] for r in ordered if r["piece"] > 0] == [64, 128, 192]
    assert all(r["turn"] == sorted(r["turn"]) for r in ordered)
    again = transcripts.pieces(turns.repartition(7), "conv_id", "turn", "role", "text")
    assert again.selectExpr("explode(turns) AS t").groupBy("t").count().exceptAll(cut.selectExpr("explode(turns) AS t").groupBy("t").count()).isEmpty()


def test_parsed_turns_with_unknown_and_long_rows(spark):
    long = "word " * 50_000
    turns = [(1, 0, "user", "Hi"), (1, 1, None, "no marker here"), (1, 2, "assistant", long), (2, 0, None, "User: written out"), (2, 1, "user", "b")]
    cut = transcripts.pieces(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    got = {(r["conv_id"], r["turn"]): r for r in transcripts.parse(cut, transcripts.learn(cut)).collect()}
    assert got[1, 0]["rendered"] == transcripts.rendered("user", "Hi\nno marker here")
    assert got[1, 1]["rendered"] == transcripts.rendered("assistant", long)
    assert got[2, 0]["rendered"] == transcripts.rendered("user", "written out")
