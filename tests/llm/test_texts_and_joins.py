"""Shingle operators against brute force: text hashing, Jaccard join, containment, repeats."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chunks, components, decontaminate, jaccard, suffixes, text

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(body, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (body or "").translate(FOLD))
    return frozenset([tuple(words)] if 0 < len(words) < n else [tuple(words[k : k + n]) for k in range(len(words) - n + 1)])


def edge_docs(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.withColumns({c: F.lit("other") for c in ("id", "chunk", "tokens", "n", "bucket", "_text", "shard", "Source")})


def near_copies(seed, families=20):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)]
    rows = []
    for _ in range(families):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(1, 50))]
        for _ in range(draw.randint(1, 10)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                k = draw.randrange(len(copy))
                copy[k : k + 1] = [draw.choice(vocabulary) for _ in range(draw.randint(0, 2))] or ["q"]
            rows.append((3 * len(rows), " ".join(copy) if draw.random() < 0.8 else "\t".join(copy).upper()))
    rows += [(9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "One  two"), (9006, "one two three"), (9007, "é É e É é"), (None, "no id at all here")]
    draw.shuffle(rows)
    return rows


def test_shingles_match_words():
    bodies = ["", "a", "a b c d", "A b  c\nd e", "a b c d e f", "x" * 3000 + " y", "é\u00a0ü b", " lead", "tail "]
    data, offsets = text.as_bytes(text.pa.array([*bodies, None]))
    hashes, at = text.shingles(data, offsets)
    seen = {}
    for i, body in enumerate([*bodies, None]):
        own = hashes[at[i] : at[i + 1]]
        assert len(set(own.tolist())) == len(shingle_set(body))
        for h in set(own.tolist()):
            seen.setdefault(h, set()).add(i)
    assert {frozenset(s) for s in seen.values() if len(s) > 1} == {frozenset({3, 4})}


def test_long_texts_are_cut_at_white_space(monkeypatch):
    body = " ".join(f"w{i % 977}" for i in range(4000)) + " " + "z" * 500
    data, offsets = text.as_bytes(text.pa.array([body]))
    whole, _ = text.words(data, offsets)
    monkeypatch.setattr(text, "BLOCK", 256)
    assert (text.words(data, offsets)[0] == whole).all()


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_components_match_brute_force(spark):
    rows = near_copies(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_components(edge_docs(spark, rows)).collect()}
    expected = brute_components([(i if i is not None else 1 << 62, t) for i, t in rows])
    assert got == {(None if i == 1 << 62 else i): (n, None if c == 1 << 62 else c) for i, (n, c) in expected.items()}


def test_jaccard_of_chains_and_common_shingles(spark, monkeypatch):
    # a chain in which neighbours share rare shingles, and sets that share common ones without a link
    words = lambda k: [f"c{k + i}" for i in range(40)]
    chain = [(i, " ".join(words(4 * i))) for i in range(300)]
    draw = random.Random(12)
    common = " ".join(f"common{i}" for i in range(30))
    template = [(1000 + i, common + " " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(14))) for i in range(150)]
    rows = chain + template
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "QUICK_ORDERS", 1)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_components(edge_docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_close_pairs_lose_no_link():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 60, draw.integers(20, 50)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(60)]
    maps = np.array([np.frombuffer(jaccard.parity(x), np.uint64) for x in sets])
    n, ids = np.array([len(x) for x in sets]), draw.permutation(60)
    component = np.arange(60) // 2
    i, j = jaccard.close_pairs(np.zeros(60, np.int64), np.arange(60) % 3, np.zeros(60, bool), ids, n, component, maps, 75)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    assert all(ids[a] < ids[b] for a, b in found)
    for a in range(60):
        for b in range(60):
            common = len(np.intersect1d(sets[a], sets[b]))
            if ids[a] < ids[b] and component[a] != component[b] and 100 * common >= 75 * (n[a] + n[b] - common):
                assert (a, b) in found


def test_jaccard_of_repeated_and_null_ids(spark):
    body = "a b c d e f g h i j k"
    rows = [(5, body), (5, body), (5, "other words of a different kind here"), (7, body), ((1 << 63) - 1, "x y z"), (None, body), (None, "x y z"), (None, "only null ids hold this text"), (None, "only null ids hold this text")]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.similarity_components(edge_docs(spark, rows)).collect()), key=str)
    last = (1 << 63) - 1
    assert got == sorted([(5, 5), (5, 5), (5, 5), (7, 5), (last, last), (None, 5), (None, last), (None, None), (None, None)], key=str)
    kept = jaccard.one_of_each(edge_docs(spark, [*rows, (8, None), (8, None), (9, " ")]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(5, body), (5, rows[2][1]), (last, "x y z"), (None, rows[7][1]), (8, None), (8, None), (9, " ")], key=str)


def test_jaccard_keeps_one_of_each_group(spark):
    docs = edge_docs(spark, [(3, "a b c d e f"), (2, "a b c d e f"), (5, None), (6, "x y")])
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 5, 6]


def test_parity_never_exceeds_the_difference():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(draw.integers(0, 1 << 63, draw.integers(1, 400)).astype(np.uint64)) for _ in range(2))
        b = np.union1d(a[: len(a) // 2], b)
        bits = np.bitwise_count(np.frombuffer(jaccard.parity(a), np.uint8) ^ np.frombuffer(jaccard.parity(b), np.uint8)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}
    assert components.components(links.limit(0)).count() == 0


def test_contained_items_match_brute_force(spark):
    draw = random.Random(8)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 30)))) for k in range(12)] + [(90, None), (91, ""), (92, "Rare Item")]
    rows = [(i, " ".join([draw.choice(vocabulary) for _ in range(draw.randint(0, 40))] + (draw.choice(items)[1] or "").split()[draw.randint(0, 2) :] + ["end"])) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "rare item"), (5, "rare  ITEM")]
    expected = sorted((i, k, len(shingle_set(q)), len(shingle_set(q) & shingle_set(t))) for i, t in rows for k, q in items if shingle_set(q) and 100 * len(shingle_set(q) & shingle_set(t)) >= 75 * len(shingle_set(q)))
    tests = spark.createDataFrame(items, "item_id long, text string")
    docs = edge_docs(spark, rows)
    for size in (8 << 20, 200):  # broadcast, and joined
        assert sorted(map(tuple, decontaminate.contained_items(docs, tests, broadcast_bytes=size).collect())) == expected
        kept = decontaminate.decontaminated(docs, tests, broadcast_bytes=size)
        assert kept.columns == docs.columns
        assert sorted(r.text or "" for r in kept.collect()) == sorted(t or "" for i, t in rows if not any(e[0] == i and shingle_set(t) for e in expected if 100 * len(shingle_set(dict(items)[e[1]]) & shingle_set(t)) >= 75 * e[2]))
    assert decontaminate.contained_items(docs, tests.limit(0)).count() == 0
    assert decontaminate.contained_items(docs.limit(0), tests).count() == 0


def brute_repeats(rows, span):
    first = {}
    for i, t in rows:
        body = (t or "").encode()
        for s in range(len(body) - span + 1):
            w = body[s : s + span]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        body = (t or "").encode()
        gone = bytearray(len(body))
        for s in range(len(body) - span + 1):
            if first[body[s : s + span]] < i:
                gone[s : s + span] = b"\1" * span
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        out.append((i, len(body), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("hot", "share"), [(suffixes.HOT, suffixes.SHARE), (1, 50), (2, 400)])
def test_repeats_match_brute_force(spark, monkeypatch, hot, share):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "SHARE", share)
    draw = random.Random(3)
    passages = ["".join(draw.choice("ab \n") for _ in range(draw.randint(40, 160))) for _ in range(12)]
    rows = [(i, "".join(draw.choice(passages) if draw.random() < 0.7 else "".join(draw.choice("cdefgh") for _ in range(draw.randint(0, 70))) for _ in range(draw.randint(0, 4)))) for i in range(120)]
    rows += [(300, None), (301, ""), (302, "x" * 400), (303, "x" * 49), (304, "x" * 50), (305, "x" * 51), (7, passages[0] * 2), (7, passages[0] * 2), (306, "ü" * 60), (307, "ü" * 60)]
    draw.shuffle(rows)
    monkeypatch.setattr(suffixes, "chunked", lambda *a: chunks.chunked(*a, chunk_bytes=4096))
    got = suffixes.remove_repeats(edge_docs(spark, rows)).collect()
    assert sorted(tuple(r)[:5] for r in got) == brute_repeats(rows, 50)
    by_id = {i: t for i, t in rows if i != 7}
    for r in (r for r in got if r.doc_id in by_id):
        body = (by_id[r.doc_id] or "").encode()
        cut = b"".join(body[a:b] for a, b in zip([0, *(s.end for s in r.spans)], [*(s.start for s in r.spans), len(body)], strict=True))
        assert cut == bytes(r.kept)


def test_repeats_around_a_common_passage_with_extreme_and_null_ids(spark, monkeypatch):
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(120))
    noise = lambda: "".join(draw.choice("xyz") for _ in range(draw.randint(0, 90)))
    largest = (1 << 63) - 1
    rows = [(i * 1000 - 5000, noise() + passage + noise()) for i in range(60)] + [(largest, passage), (-largest - 1, "x" * 60), (largest - 1, "x" * 60)]
    monkeypatch.setattr(suffixes, "chunked", lambda *a: chunks.chunked(*a, chunk_bytes=2048))
    monkeypatch.setattr(suffixes, "HOT", 3)
    got = suffixes.remove_repeats(edge_docs(spark, [*rows, (None, passage), (None, passage), (None, "q" * 80)]), with_text=False).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute_repeats(rows, 50)
    assert sorted(r.n_removed for r in got if r.doc_id is None) == [0, 120, 120]


def test_chunks_follow_the_ids():
    draw = np.random.default_rng(5)
    ids = np.sort(draw.integers(-(1 << 62), 1 << 62, 2000))
    for steps in (1, 7):
        places = chunks.place_of(ids, np.array([ids[0], *ids[200:2000:200], ids[-1]]), steps)
        assert (np.diff(places) >= 0).all() and places.min() == 0 and places.max() == 10 * steps - 1


def test_repeats_of_an_empty_table(spark):
    docs = edge_docs(spark, [(1, "a")]).limit(0)
    assert suffixes.remove_repeats(docs).count() == 0
    assert jaccard.similarity_components(docs).count() == 0


def test_long_text_blocks_see_all_strings(monkeypatch):
    body = bytes(random.Random(1).choice(b"abc") for _ in range(3000))
    data, offsets = np.frombuffer(body, dtype=np.uint8), np.array([0, len(body)])
    monkeypatch.setattr(suffixes, "BLOCK", 512)
    _, start, length, _, _ = suffixes.stretches(data, offsets)
    assert sorted(s + k for s, n in zip(start, length, strict=True) for k in range(n)) == list(range(len(body) - 49))


def test_suffix_levels_grow_geometrically():
    draw = np.random.default_rng(2)
    keys = draw.integers(97, 100, (40, 30, 4)).astype(np.uint8)
    levels = suffixes.SuffixLevels(keys.ravel(), 4)
    seen: dict[bytes, int] = {}
    for batch in range(40):
        documents = np.sort(draw.integers(batch * 3, batch * 3 + 3, 30))
        got = levels.add(4 * (30 * batch + np.arange(30)), documents)
        for k, d in zip(keys[batch], documents.tolist(), strict=True):
            seen[k.tobytes()] = min(seen.get(k.tobytes(), d), d)
        assert got.tolist() == [seen[k.tobytes()] < d for k, d in zip(keys[batch], documents.tolist(), strict=True)]
    for places, _ in levels.levels:
        ordered = levels.bytes_at(places)
        assert (ordered[1:] > ordered[:-1]).all()
    sizes = [len(k) for k, _ in levels.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


def test_ids_must_be_integers(spark):
    with pytest.raises(TypeError):
        suffixes.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


@pytest.mark.parametrize("few", [0, 5, 1000])
def test_components_are_the_same_in_one_task_and_in_many(spark, few):
    draw = random.Random(few)
    pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)] + [(i + 101, i + 100) for i in range(20)]
    least = {x: x for pair in pairs for x in pair if pair[0] != pair[1]}
    for _ in least:
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    rows = components.components(spark.createDataFrame(pairs, "a long, b long"), few).collect()
    assert len(rows) == len(least) and {r.node: r.component for r in rows} == least


def test_few_links_need_no_rounds(spark, monkeypatch):
    def never(edges):
        raise AssertionError("a round of joins for a few links")

    monkeypatch.setattr(components, "_large_star", never)
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.component for r in components.components(links).collect()} == {0}
