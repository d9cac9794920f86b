"""Term scan, ring SimHash and Merkle manifest against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hazardbook.llm import merkle_manifest, personal_data, ring_simhash, term_scan
from hazardbook.llm.common import held_out

LONG = "lorem ipsum dolor sit amet " * 20_000
ODD = [(None, None, None, None), (1, None, None, "a"), (2, "", "en", None), (3, " \t\n", "en", "a"), (4, LONG, "en", "a")]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# op11


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))


def brute_ranks(docs, items, k):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total, count = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 50 + ((50 * sum(c.values()) * count) // total)
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms_of(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(found, key=repr)


def ranks(found):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, doc_id string, score int")


def test_ranks_equal_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(11)
    docs = [(i, words(rng, rng.randrange(1, 60), 80).replace("w1", "W1").replace("w2 ", "w2-é, ")) for i in range(300)]
    docs += [(300 + i, docs[5][1]) for i in range(20)] + [(7, docs[7][1]), (None, docs[5][1]), *[r[:2] for r in ODD]]
    items = [(i, words(rng, 6, 80).replace("w3", "É w3")) for i in range(12)] + [(12, docs[5][1]), (12, "w4 w5"), (13, None), (14, " .. "), (None, "w6"), (15, "nowhere")]
    expected = brute_ranks(docs, items, 10)
    got = term_scan.ranked(docs_of(docs), "doc_id", "text", items_of(spark, items), "item_id", "text", k=10)
    assert ranks(got) == expected
    monkeypatch.setattr(term_scan, "BLOCK_BYTES", 60)  # many blocks of items
    monkeypatch.setattr(term_scan, "CELLS", 100)  # few rows at a time
    got = term_scan.ranked(docs_of(docs), "doc_id", "text", items_of(spark, items), "item_id", "text", k=10)
    assert ranks(got) == expected


def test_ranks_of_empty_tables(spark, docs_of):
    some, none = items_of(spark, [(1, "w1")]), items_of(spark, [(1, "w1")]).where("false")
    docs = docs_of([(1, "w1")])
    assert term_scan.ranked(docs_of([]), "doc_id", "text", some, "item_id", "text").count() == 0
    assert term_scan.ranked(docs_of(ODD[:4]), "doc_id", "text", some, "item_id", "text").count() == 0
    assert term_scan.ranked(docs, "doc_id", "text", none, "item_id", "text").count() == 0
    assert term_scan.ranked(docs, "doc_id", "text", items_of(spark, [(1, None)]), "item_id", "text").count() == 0


def test_scan_counts_whole_terms_of_every_text():
    texts = ["a b a", "ab A a-b", "", "\x00a\x7fé a", "é", "aé a b"]
    block = term_scan.Block([0], [b"a", b"b", "é".encode()], [[0], [0], [0]])
    cleaned = [term_scan.cleaned(t.encode()) for t in texts]
    lengths, of, terms, counts = term_scan.scan(block.automaton(), cleaned, 3)
    assert lengths.tolist() == [len(terms_of(t)) for t in texts]
    got = {(int(d), block.terms[t].decode()): int(n) for d, t, n in zip(of, terms, counts, strict=True)}
    plain = {(d, t): n for d, text in enumerate(texts) for t, n in Counter(terms_of(text)).items() if t in ("a", "b", "é")}
    assert got == plain


# op12


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(prints):
    """Smallest member reached by links of at most two bits, by position."""
    label = list(range(len(prints)))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    while True:
        low = np.array([min(np.array(label)[near[i]]) for i in range(len(prints))])
        if (low == label).all():
            return label
        label = low.tolist()


def test_fingerprints_equal_brute_force(docs_of):
    rng = random.Random(12)
    texts = [words(rng, n, 90).replace("w1", "W1\t\n") for n in (1, 2, 3, 4, 40, 400)] + ["", "  ", "É é É É", " a  b\x0bc ", "a\x00b c d"]
    assert [ring_simhash.fingerprint(t.encode(), 3) % 2**64 for t in texts] == [brute_print(t) for t in texts]
    whole = ring_simhash.fingerprint(LONG.encode(), 3)
    piece, ring_simhash.PIECE = ring_simhash.PIECE, 1000
    assert ring_simhash.fingerprint(LONG.encode(), 3) == whole
    ring_simhash.PIECE = piece


def test_components_of_texts(docs_of):
    rng = random.Random(13)
    base = words(rng, 300).split()
    rows = [*ODD, (9, LONG), (4, LONG), (None, LONG), (20, ""), (21, "Two words"), (22, "two WORDS")]
    for i in range(30):
        copy = list(base)
        copy[rng.randrange(300)] = f"x{i}"
        rows.append((100 + i, " ".join(copy)))
    got = ring_simhash.near_components(docs_of(rows), "doc_id", "text").collect()
    assert len(got) == len(rows)
    prints = np.array([brute_print(r[1]) for r in rows], np.uint64)
    labels = brute_labels(prints)
    low = {}
    for (i, *_), label in zip(rows, labels, strict=True):
        if i is not None:
            low[label] = min(i, low.get(label, i))
    expected = sorted(((r[0], f"{int(p):016x}", low.get(x)) for r, p, x in zip(rows, prints, labels, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == expected
    alone = ring_simhash.near_components(docs_of([(None, "a b c d"), (None, "a b c d")]), "doc_id", "text").collect()
    assert [r["component_id"] for r in alone] == [None, None]
    assert ring_simhash.near_components(docs_of([]), "doc_id", "text").count() == 0


@pytest.mark.parametrize("crowd", [2, 32, 10**9])
def test_links_join_what_brute_force_joins(spark, monkeypatch, crowd):
    """Dense clusters, chains at the very bound, and fingerprints alone; with signatures
    that are all crowded, mixed, and all small."""
    monkeypatch.setattr(ring_simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1, 1 << 63, (1 << 63) | 1}
    for centre in list(prints)[:6]:
        for _ in range(60):
            x = centre
            for _ in range(rng.randrange(1, 7)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    x = rng.getrandbits(64)
    for _ in range(40):
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        prints.add(x)
    prints = np.array(sorted(prints), np.uint64)
    nodes = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "node long")
    got = [(r["a"], r["b"]) for r in ring_simhash.links(nodes).collect()]
    place = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    joined = list(range(len(prints)))

    def top(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for a, b in got:
        assert bin(a ^ b if (a < 0) == (b < 0) else (a ^ b) & (2**64 - 1)).count("1") <= 2 or crowd < 10**9
        a, b = sorted((top(place[a]), top(place[b])))
        joined[b] = a
    assert [top(i) for i in range(len(prints))] == brute_labels(prints)


def test_chains_in_budget_are_implied_by_the_distance():
    rng = random.Random(0)
    for _ in range(3000):
        bits = 0
        for _ in range(ring_simhash.WITHIN):
            bits |= 1 << rng.randrange(64)
        apart = [bin(bits >> 4 * i & 15).count("1") for i in range(16)]
        assert any(all(sum(apart[(s + j) % 16] for j in range(n)) <= ring_simhash.budget(n) for n in range(1, 17)) for s in range(16))


# op13


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([digest("".join(row[i : i + 16])) for i in range(0, len(row), 16)])
    return levels


def path_of(levels, at):
    found = []
    for row in levels[:-1]:
        first = at // 16 * 16
        found.append(("".join(row[first:at]), "".join(row[at + 1 : first + 16])))
        at //= 16
    return found


def brute_manifest(rows):
    """Rows are (doc_id, text, lang, source); n_chars is null."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r, leaf_of((r[0], r[3], r[2], None, r[1]))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = levels_of([leaf for _, leaf in by[s]])
    upper = levels_of([trees[s][-1][0] for s in sources])
    root = upper[-1][0]
    found = []
    for j, s in enumerate(sources):
        for i, (r, leaf) in enumerate(by[s]):
            path = path_of(trees[s], i) + path_of(upper, j)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf_of((r[0], s, r[2], None, None if r[1] is None else lower(r[1]))) if changed else leaf
            for before, after in path:
                folded = digest(before + folded + after)
            found.append((r[0], leaf, trees[s][-1][0], root, digest("".join(b + a for b, a in path)), folded, folded == root))
    return sorted(found, key=repr)


def verified(docs):
    got = merkle_manifest.verified_rows(docs, "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], "text", held_out())
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == columns
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("counts", [[1], [2], [16], [17], [256], [257, 1, 0, 16], [600, 300, 33, 1]])
def test_manifest_equals_brute_force(docs_of, counts):
    rng = random.Random(sum(counts))
    rows = []
    for s, n in enumerate(counts):
        source = [None, "a", "é", "Z"][s]
        rows += [(rng.randrange(-10**6, 10**6), words(rng, 3).replace("w1", "W1"), rng.choice(["en", None]), source) for _ in range(n)]
    rng.shuffle(rows)
    got = verified(docs_of(rows))
    assert got == brute_manifest(rows)
    assert any(not r[-1] for r in got) or len(rows) < 30


def test_manifest_of_odd_rows_and_many_sources(docs_of):
    rows = [*ODD, *ODD, (4, "Ab", "en", "a"), *[(i, "Same", "en", f"s{i % 300:03d}") for i in range(330)], *[(8, "copy", None, "c")] * 300]
    assert verified(docs_of(rows)) == brute_manifest(rows)
    assert verified(docs_of([])) == []
    leaves = docs_of([]).select("source", "doc_id", F.lit("x").alias("leaf"))
    empty = merkle_manifest.manifest(leaves, "source", "doc_id", "leaf", ["doc_id"])
    assert empty.root is None and empty.proofs().count() == 0


def test_only_every_second_level_is_stored(docs_of):
    docs = docs_of([(i, str(i), None, "a") for i in range(600)])
    leaves = docs.select("source", "doc_id", merkle_manifest.leaf_digest(F.col("text")).alias("leaf"))
    found = merkle_manifest.manifest(leaves, "source", "doc_id", "leaf", ["doc_id"])
    assert [level.selectExpr("sum(size(members))").head()[0] for level in found.levels] == [600, 3]


# op10, spellings that the table of examples does not hold


def held_out_line(rng):
    """A line, and the kind and place of the personal data in it."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    some = "please tonight about order offer garden window letter morning early simple yellow river".split()
    before, after = (" ".join(rng.choices(some, k=rng.randrange(1, 4))) for _ in range(2))
    kind, value, tail = rng.choice([None, None, None, "phone", "email", "ip"]), "", ""
    if kind == "phone":
        value = rng.choice([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"0{digits(2)} {digits(4)} {digits(4)}"])
    elif kind == "email":
        value = f"{rng.choice(['ann', 'joe.p', 'x_1', 'team'])}@{rng.choice(['desk', 'server', 'home', 'lab2'])}"
    elif kind == "ip":
        value, tail = ".".join(str(rng.randrange(256)) for _ in range(4)), f":{rng.randrange(20, 9999)}"
    else:
        tail = rng.choice([f"{rng.randrange(1900, 2030)}", f"{digits(2)}.{digits(2)}", f"20{digits(2)}-0{rng.randrange(1, 9)}-1{digits(1)}", f"{digits(1)}.{digits(1)}.{digits(2)}",
                           f"id {digits(6)}", f"{digits(2)}:{digits(2)}", f"{digits(1)},{digits(3)},{digits(3)}", f"{digits(2)} to {digits(3)}", "@office"])
    spans = {(len(before) + 1, personal_data.KINDS.index(kind), len(before) + 1 + len(value))} if kind else set()
    return f"{before} {value}{tail} {after}", spans


def test_field_finds_held_out_spellings():
    rng, model = random.Random(1), personal_data.train()
    right = found = wanted = by_field = 0
    for _ in range(2000):
        text, spans = held_out_line(rng)
        base = personal_data.base_spans(text)
        added = personal_data.added_spans([text], [base], model)[0]
        right += len({*base, *added} & spans)
        found += len({*base, *added})
        wanted += len(spans)
        by_field += len({*added} & spans)
    assert right / found >= 0.97 and right / wanted >= 0.9
    assert by_field > 0.5 * wanted
