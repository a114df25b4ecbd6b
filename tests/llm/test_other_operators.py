"""URL rules, sharding, media, toxicity, WARC, BPE, personal data and the pipeline."""

import base64
import glob
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, jaccard, media, pii, registry, shared, sharding, suffixes, toxicity, urlrules, warc

FOLDER = "/root/testdata/sf0.001"
EXTRA = ("id", "chunk", "key", "range", "_id", "_text", "media", "shard", "_block", "Body")


def edge_docs(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind).withColumns({c: F.lit("other") for c in EXTRA})


# --- urls ----------------------------------------------------------------------------------


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules_match_brute_force(spark):
    rules = [*registry.URL_RULES, ("b.org", "/", "allow"), ("a.b.org", "/fr/x", "block"), ("org", "/fr/xyz", "allow")]
    draw = random.Random(2)
    hosts = ["net", "example.net", "www.EXAMPLE.net", "xexample.net", "org", "b.org", "a.b.org", "c.a.b.org", "de.example.com", "", "é.org"]
    urls = [f"{draw.choice(['http', 'https'])}://{draw.choice(hosts)}{draw.choice(['', '/', '/en/', '/de/x', '/fr/xyz/1', '/fr/x?y#z', '?q=/fr/', '#/'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "a://b://c.org/fr/", "://net/"]
    pages = edge_docs(spark, list(enumerate(urls)), "page_id long, url string").unionAll(edge_docs(spark, [(0, urls[0])], "page_id long, url string"))
    table = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    got = urlrules.judge_urls(pages, table).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_verdict(urls[r.page_id], rules)
    assert urlrules.judge_urls(pages.limit(0), table).count() == 0
    assert {r.verdict for r in urlrules.judge_urls(pages, table.limit(0)).collect()} == {"allow"}


# --- sharding ---------------------------------------------------------------------------------


def plain_jump(key, buckets):
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one():
    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 500)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [plain_jump(int(k) % (1 << 64), n) for k in keys]


def test_shards_are_gapless_and_stable(spark):
    rows = [(i, f"text {i % 7}") for i in range(2000)] + [(None, None), (5, ""), (5, "")]
    got = sharding.assign_shards(edge_docs(spark, rows), 24).collect()
    assert len(got) == len(rows)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.grown_shard in (r.shard, 24) for r in got) and {r.shard for r in got} <= set(range(24))
    bodies = {r: t for r, t in rows if r != 5}
    for r in got:
        if r.doc_id != 5:
            body = (bodies[r.doc_id] or "").encode()
            assert (r["size"], r.text_crc32, r.law) == (len(body) + 8, zlib.crc32(body), "key")


# --- media --------------------------------------------------------------------------------------


def test_frames_survive_coding():
    draw = np.random.default_rng(3)
    for samples in (np.full((3, 576), 255, np.uint8), draw.integers(0, 256, (50, 576), dtype=np.uint8), np.where(draw.random((20, 576)) < 0.5, 0, 255).astype(np.uint8)):
        coded, offsets = media.encode_frames(samples)
        assert (media.decode_frames(media.HEADER, coded, offsets) == samples).all()
    damaged = coded.copy()
    damaged[: len(damaged) // 2] ^= 0x55
    with pytest.raises(ValueError):
        media.decode_frames(media.HEADER, damaged, offsets)


def test_media_round_trip(spark):
    rows = [(1, None), (2, ""), (3, "a" * 576), (4, "é" * 5000), (5, "x" * 577), (6, "a" * 576), (6, "a" * 576)]
    stored = media.store(edge_docs(spark, rows))
    got = media.describe(stored).collect()
    assert len(got) == len(rows)
    bodies = {i: (t or "").encode() for i, t in rows}
    for r in got:
        payload = bodies[r.doc_id] + b"\xff" * (-len(bodies[r.doc_id]) % 576 or (0 if bodies[r.doc_id] else 576))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(bodies[r.doc_id]), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    files = {r.doc_id: bytes(r.media) for r in stored.collect()}
    assert files[3] == files[6] and files[1] == files[2]
    assert all(files[r.doc_id][:4] == b"RIFF" and len(files[r.doc_id]) == r.media_bytes for r in got)
    assert media.describe(media.store(edge_docs(spark, rows).limit(0))).count() == 0


def test_shots_are_cut_where_histograms_change(spark):
    body = "a" * 576 * 6 + "0" * 576 * 4
    shots = media.clips(media.store(edge_docs(spark, [(1, body), (2, "b")]))).orderBy("doc_id", "clip").collect()
    assert [tuple(r) for r in shots] == [(1, 0, 0, 5, 0, 240), (1, 1, 6, 9, 240, 400), (2, 0, 0, 0, 0, 40)]


def test_damaged_files_have_an_error(spark):
    files = {r.doc_id: bytes(r.media) for r in media.store(edge_docs(spark, [(1, "abc" * 900), (2, "z")])).collect()}
    good = files[1]
    place = media.frame_places(good)[1]
    bits = bytearray(good)
    bits[place[0] + len(media.HEADER) : place[0] + place[1] - 2] = bytes(place[1] - 2 - len(media.HEADER))
    header = bytearray(good)
    header[place[0] + 5] ^= 1
    rows = [(0, files[2]), (1, good), (2, None), (3, b""), (4, b"RIFFxxxxWAVE"), (5, good[: len(good) // 2]), (6, bytes(bits)), (7, bytes(header)), (8, good[:-20]), (9, good)]
    frame = spark.createDataFrame([(i, 5, bytearray(f) if f is not None else None) for i, f in rows], "doc_id long, n_bytes long, media binary").coalesce(1)
    got = {r.doc_id: r for r in media.describe(frame).collect()}
    assert {i for i, r in got.items() if r.error is None} >= {0, 1, 9} and {i for i, r in got.items() if r.error} >= {2, 3, 4, 5, 6, 7}
    for r in got.values():
        assert (r.payload_sha256 is None) == (r.clips is None) == (r.error is not None)
    assert got[1].payload_sha256 == got[9].payload_sha256 == hashlib.sha256(b"abc" * 900 + b"\xff" * (2880 - 2700)).hexdigest()
    assert {r.doc_id for r in media.clips(frame).collect()} == {i for i, r in got.items() if r.error is None}


def test_long_media_round_trip(spark):
    body = "ab c" * 200_000
    r = media.describe(media.store(edge_docs(spark, [(1, body)]))).first()
    payload = body.encode() + b"\xff" * (-len(body) % 576)
    assert (r.payload_sha256, r.error) == (hashlib.sha256(payload).hexdigest(), None) and r.clips[-1].last_frame == len(payload) // 576 - 1


# --- toxicity --------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    draw = random.Random(5)
    syllables = ["an", "the", "re", "on", "sh", "ti", "er", "ou", "nd", "le"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))
    bad = ["blockhead", "vermin", "dimwit"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = [draw.choice(bad) if toxic and draw.random() < 0.08 else word() for _ in range(draw.randint(40, 200))]
        rows.append((i, " ".join(words + ([draw.choice(bad)] * 2 if toxic else []))))
        labels.append((i, int(toxic)))
    docs = edge_docs(spark, [*rows, (5000, None), (5001, ""), (None, "the")])
    known = spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.scores(docs, toxicity.train(docs, known)).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    none = toxicity.train(docs, known.limit(0))
    assert {r.predicted for r in toxicity.scores(docs, none).collect()} == {0}
    assert toxicity.without_toxic(docs, none).columns == docs.columns


def test_scores_are_those_of_window_gains(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    text = lambda n: " ".join([word() for _ in range(60)] + ["zoqutix"] * n)
    rows = [(i, text(6 * (i % 4 == 0))) for i in range(400)]
    held = next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0)
    docs = edge_docs(spark, [*rows, (900, None), (901, " ".join([word() for _ in range(60_000)])), rows[held], rows[held]])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] * 2 + [(901, 0), (901, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    used = [(t.encode(), i % 4 == 0) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    alone = toxicity.fit(sorted(t for t, y in used if y), sorted(t for t, y in used if not y), sum(y for _, y in used), sum(not y for _, y in used))
    assert (model.ordinary, model.toxic) == (alone.ordinary, alone.toxic) and np.allclose(model.weights, alone.weights)
    size = lambda w, d: len(zstandard.ZstdCompressor(level=model.level, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress(w))

    def brute(body):
        gains = sorted((size(w, model.ordinary) - size(w, model.ordinary + model.toxic) for w in toxicity.windows(body)), reverse=True)
        if not gains:
            x = np.zeros(8)
        else:
            top = [*gains, 0]
            beyond = [sum(max(g - t, 0) for g in gains) for t in (1, 2, 3)]
            x = np.array([top[0], top[1], top[0] * math.log1p(len(gains)), *map(math.log1p, beyond), math.log1p(len(gains)), beyond[0] / len(gains)])
        return 1 / (1 + math.exp(-min(max(model.weights[0] + x @ model.weights[1:], -30), 30)))

    bodies = dict(rows) | {900: ""}
    got = toxicity.scores(docs, model).collect()
    assert len(got) == len(rows) + 4 and len({r.score for r in got if r.doc_id == held}) == 1
    for r in got:
        if r.doc_id in bodies and r.doc_id % 9 == 0:
            assert math.isclose(r.score, brute(bodies[r.doc_id].encode()), rel_tol=1e-9)


def test_toxic_words_that_ordinary_rows_hold_by_chance_are_learnt():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    bad = ["zoqutix", "wukjomp", "xyvorun"]
    text = lambda n: " ".join([word() for _ in range(60 - n)] + [draw.choice(bad) for _ in range(n)]).encode()
    # a toxic row repeats the words, every second ordinary row holds one: no ratio of document shares reaches 10
    toxic, ordinary = [text(8) for _ in range(100)], [text(i % 2) for i in range(400)]
    found = {int(g).to_bytes(8, "little")[:5] for g in toxicity.toxic_grams(toxic, ordinary, 5)}
    assert found >= {f" {w}"[:5].encode() for w in bad}
    assert not any(set(g) <= set(b" abcdefgh") for g in found)


def test_windows_hold_the_whole_text():
    for body in (b"", b"a" * 200, b"ab cd " * 50, b" " * 130):
        assert b"".join(toxicity.windows(body)) == body


# --- archives -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_reject_magic_in_payloads(spark, tmp_path, compression):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:millrace:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/", "one"), (2, None, "one"), (3, "u\r\nX: y", None), (4, "u", ""), (5, "u", fake), (6, "u", fake + "x" + fake), (7, "u", "WARC/1.0\r\n"), (8, "ü", "é" * 300), (9, "u", "one"), (10, "u", "x" * 5000)]
    path = f"{tmp_path}/a"
    warc.write_archives(edge_docs(spark, rows, "page_id long, url string, html string"), path, compression=compression)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = {int(r["id"]): r for r in warc.read_archives(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == [r[0] for r in rows]
    first = {}
    for i, _, body in rows:
        first.setdefault(body or "", i)
    for i, _, body in rows:
        raw = (body or "").encode()
        kind, refers = ("response", None) if first[body or ""] == i else ("revisit", str(first[body or ""]))
        assert (got[i].kind, got[i].refers, got[i].bytes, got[i].digest) == (kind, refers, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())


def test_damaged_archives_keep_what_is_reachable(spark, tmp_path):
    path = f"{tmp_path}/a"
    warc.write_archives(spark.createDataFrame([(i, "u", f"page {i}") for i in range(5)], "page_id long, url string, html string").coalesce(1), path, compression="none")
    name = next(n for n in glob.glob(f"{path}/part-*") if os.path.getsize(n))
    body = open(name, "rb").read()
    starts = [m.start() for m in re.finditer(rb"WARC/1\.0\r\n", body)]
    os.remove(os.path.join(path, f".{os.path.basename(name)}.crc"))
    open(name, "wb").write(body[: starts[-1] + 40])
    assert warc.read_archives(spark, path).count() == len(starts) - 2
    assert warc.reachable(np.array([0, 10, 20]), np.array([20, 15, 30]), 30).tolist() == [True, False, True]


# --- tokens ----------------------------------------------------------------------------------------------


def test_tokens_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = registry.vocabulary()
    library = tokenizers.Tokenizer.from_file(vocabulary)
    draw = random.Random(1)
    pool = " \t\n\r\x0b\x1c\x85\xa0\u2003\u3000abcdeXYZ019²½'strevmlld.,!é中😀\u0301\x00_"
    bodies = ["", None, "a" * 3000, "ab" * 4000, "<|endoftext|>", "x<|endoftext|>y", "it's WE'LL"] + ["".join(draw.choice(pool) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    got = {r.doc_id: r for r in bpe.round_trip(edge_docs(spark, list(enumerate(bodies))), vocabulary).collect()}
    for i, body in enumerate(bodies):
        ids = library.encode(body or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    docs = spark.createDataFrame([(1, "round trip é")], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, vocabulary), vocabulary).first().text == "round trip é"


# --- personal data ------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(body):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, body or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else True, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_spans_match_brute_force(spark):
    draw = random.Random(5)
    pool = ["@", "a", "b.c", ".", "+", "1", "23", " ", "-", "(", ")", "4111111111111111", "5500 0000 0000 0004", "é", "😀", "_", "%", "+12 345 678 90", "\n", "10.0.0.1", "256.1.1.1"]
    bodies = [None, "", "+1 (017) 555-7713", "a@b.c_d@e.f", "1.2.3.400.5.6.7", "9" * 5000, "a" * 5000 + "@b.c"] + ["".join(draw.choice(pool) for _ in range(draw.randint(1, 25))) for _ in range(1500)]
    got = pii.find_spans(edge_docs(spark, list(enumerate(bodies)))).collect()
    assert len(got) == len(bodies)
    for r in got:
        spans = brute_spans(bodies[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in spans) for k in PATTERNS]
        assert set(spans) <= set(r.spans.split(","))if spans else True


def test_disclosing_terms_are_found_and_replaced(spark):
    rows = [(i, f"common words about nothing number {chr(97 + i % 26) * (1 + i // 26)}") for i in range(60)]
    rows += [(100, "please write Zanzibar at x@y.zz today"), (101, "the note: Zanzibar is x@y.zz too"), (102, "Zanzibar alone"), (103, "today is fine")]
    docs = edge_docs(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.find_spans(docs).collect()}
    assert spans[100] == "term:13:21,email:25:31" and spans[101] == "term:10:18,email:22:28" and spans[102] == ""
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[100] == "please write [TERM] at [EMAIL] today" and clean[102] == "Zanzibar alone"
    assert pii.sanitised(docs).columns == docs.columns and len(clean) == len(rows)
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_terms_of_an_entity_in_one_document_are_found(spark):
    rows = [(i, f"common words about nothing number {chr(97 + i % 26) * (1 + i // 26)}") for i in range(60)]
    docs = edge_docs(spark, [*rows, (100, "common words, Quixbury at q@r.st, about nothing")])
    spans = {r.doc_id: r.spans for r in pii.find_spans(docs).collect()}
    assert spans[100] == "term:14:22,email:26:32" and not any(spans[i] for i, _ in rows)
    assert {r.doc_id: r.text for r in pii.sanitised(docs).collect()}[100] == "common words, [TERM] at [EMAIL], about nothing"


def test_terms_far_from_their_entity_are_marked_throughout_its_documents(spark):
    filler = "common words about nothing " * 8
    rows = [(i, filler + chr(97 + i % 26) * (1 + i // 26)) for i in range(60)]
    docs = edge_docs(spark, [*rows, (100, f"Quixbury! {filler}q@r.st {filler}quixbury."), (101, f"{filler}q@r.st {filler} \U0001f600 QUIXBURY")])
    spans = {r.doc_id: r.spans for r in pii.find_spans(docs).collect()}
    n = len(filler)
    assert spans[100] == f"term:0:8,email:{10 + n}:{16 + n},term:{17 + 2 * n}:{25 + 2 * n}"
    assert spans[101] == f"email:{n}:{n + 6},term:{2 * n + 10}:{2 * n + 18}" and not any(spans[i] for i, _ in rows)
    assert "quixbury" not in " ".join(r.text for r in pii.sanitised(docs).collect()).lower()


def brute_disclosure(bodies, at_least=pii.MIN_DISCLOSURE):
    """Spans string of each distinct text, by counting over all of them."""
    texts = sorted({b or "" for b in bodies})
    word = regex.compile(r"[\p{L}\p{N}]{3,}")
    words = {t: [(m.start(), m.end(), m[0].lower()) for m in word.finditer(t)] for t in texts}
    base = {t: [(int(a), int(b), k) for k, a, b in (s.split(":") for s in brute_spans(t))] for t in texts}
    entities = {t: {(k, t[a:b].lower()) for a, b, k in base[t]} for t in texts}
    with_entity, with_term, both = Counter(), Counter(), Counter()
    for t in texts:
        terms = {w for *_, w in words[t]}
        with_entity.update(entities[t])
        with_term.update(terms)
        both.update((e, w) for e in entities[t] for w in terms)
    total = len(texts)

    def discloses(e, w):
        content = math.log(total / with_entity[e])
        return content > 0 and math.log(both[e, w] * total / ((with_term[w] + pii.SMOOTHING) * with_entity[e])) / content >= at_least

    order = ["email", "ip", "card", "phone", "term"]
    out = {}
    for t in texts:
        added = [(a, b, "term") for a, b, w in words[t] if any(discloses(e, w) for e in entities[t]) and all(y <= a or x >= b for x, y, _ in base[t])]
        out[t] = ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(base[t] + added, key=lambda s: (s[0], order.index(s[2]))))
    return out


def test_every_added_span_matches_brute_force(spark):
    draw = random.Random(11)
    names = ["Ann", "Bob", "Zed", "Ümit", "x1y2", "2024"]
    entity = {n: f"{n.lower()}@mail{k}.org" for k, n in enumerate(names)}
    pool = [f"w{chr(97 + i)}{chr(97 + i % 7)}" for i in range(26)] + ["10.0.0.1", "+12 345 678 90", "4111111111111111"]
    rows = []
    for i in range(150):
        who = draw.choice(names)
        words = [draw.choice(pool[:26] if draw.random() < 0.95 else pool) for _ in range(draw.randint(3, 30))]
        if draw.random() < 0.4:
            words += [who] * draw.randint(0, 2) + [entity[who]]
            draw.shuffle(words)
        rows.append((i, " ".join(words)))
    # ties, a text of many spans, and terms inside base spans
    rows += [(500, None), (501, ""), (502, " ".join(f"a{i}@b{i}.cc wort{i}" for i in range(400))), (503, "mail mail0 ann@mail0.org 10.0.0.1")]
    expected = brute_disclosure([t for _, t in rows])
    assert sum("term" in s for s in expected.values()) > 20
    once = {r.doc_id: r.spans for r in pii.find_spans(edge_docs(spark, rows)).collect()}
    assert once == {i: expected[t or ""] for i, t in rows}
    # repeated rows, null ids among them, change nothing
    again = edge_docs(spark, rows + rows + [(None, t) for _, t in rows[:40]] * 3)
    assert {(r.doc_id, r.spans) for r in pii.find_spans(again).collect()} == set(once.items()) | {(None, expected[t or ""]) for _, t in rows[:40]}


def test_sanitising_keeps_columns_and_generalises(spark):
    rows = [(i, f"common words {chr(97 + i % 26) * (1 + i // 26)}") for i in range(60)] + [(70, "common a@b.cc Quix 47110815 kx9z7"), (71, None)]
    clash = ("_m_email", "_g_ip", "_hash", "_spans", "_text", "value", "kind")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in clash})
    got = pii.sanitised(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows) and all(r[c] == "own" for r in found.values() for c in clash)
    assert found[70].text == "common [EMAIL] [TERM] [NUMBER] [CODE]" and found[71].text is None
    assert all(found[i].text == t for i, t in rows if i < 70)


def test_intermediate_tables_are_removed(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    docs = edge_docs(spark, [(i, f"some words that are {i % 3} a@b{i % 5}.cc and a few more") for i in range(30)])
    os.makedirs(base, exist_ok=True)
    before = set(os.listdir(base))
    with shared.scope(spark):
        assert pii.find_spans(docs).count() == 30 and jaccard.similarity_components(docs).count() == 30
        assert suffixes.remove_repeats(docs).count() == 30
        left = set(os.listdir(base)) - before
        assert len(left) <= 3, left
    assert set(os.listdir(base)) == before


# --- pipeline ----------------------------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns
        before = {r.doc_id for r in docs.collect()}
        rows = after.collect()
        assert {r.doc_id for r in rows} <= before
        texts = {r.doc_id: r.text for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)
        if name == "pii":
            assert {r.doc_id for r in rows} == before and not any("@mail" in t for t in texts.values())
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    tokenizer = bpe.Tokenizer(open(registry.vocabulary(), encoding="utf-8").read())
    assert set(got) == set(texts)
    for i, body in texts.items():
        assert got[i].n_tokens == len(tokenizer.encode(body))
