"""Suffix dedup, importance resampling and the Merkle manifest against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanloom.llm import importance, interleave, merkle, queries, suffix_dedup

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, rank string, leaf int, score long, "
    "runs int, own string, hash int, tree int, `key` int, weight string"
)
FOLDER = "/root/testdata/sf0.001"


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice("rain falls on old stone while Ärger naïve dogs sleep".split()) + str(draw.randrange(90)) for _ in range(words))


def make(spark, data):
    """Rows (doc_id, text, lang, n_chars) with columns whose names clash with working ones."""
    return spark.createDataFrame(
        [(k, t, g, None if n is None else f"s{n % 3}", n, "x", "y", 1, 2, 3, "o", 4, 5, 6, "w") for k, t, g, n in data], SCHEMA
    )


LONG = prose(4, 40_000)
SHARED = prose(5, 80)
ROWS = [
    (1, prose(1, 90), "de", 10),
    (2, None, "de", 3),
    (3, "", None, 4),
    (4, prose(1, 90), "de", 10),
    (5, prose(2, 20) + SHARED + prose(3, 20), "é", 7),
    (6, SHARED, "é", None),
    (7, LONG, "de", 9),
    (8, prose(7, 30) + LONG[1000:90_000] + " end", None, 9),
    (9, "a" * 5_000, "fr", 5),
    (10, "b" + "a" * 300 + "c", "fr", 5),
    (11, prose(8, 30), "", 1),
    (11, prose(8, 30), "", 1),
    (11, SHARED + "!", "", 2),
    (None, prose(1, 90), "de", 10),
    (None, prose(9, 40), None, 10),
    (21, "x" * 49, "fr", 1),
    (22, "x" * 49, "fr", 1),
    (23, "x" * 50, "fr", 1),
    (24, "x" * 51, "fr", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


# --- suffix dedup


def cut_by_hand(rows, depth=50):
    last = 2**63 - 1
    own = [(last if k is None else k, k, (t or "").encode()) for k, t, *_ in rows]
    first = {}
    for order, _, raw in sorted(own, key=lambda x: x[0]):
        for i in range(len(raw) - depth + 1):
            first.setdefault(raw[i : i + depth], order)
    out = []
    for order, k, raw in own:
        gone = bytearray(len(raw))
        for i in range(len(raw) - depth + 1):
            if first[raw[i : i + depth]] < order:
                gone[i : i + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return Counter(out)


def test_suffix_dedup_by_hand(docs, none):
    found = suffix_dedup.without_repeats(docs)
    assert found.columns == ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    assert Counter((*r[:5], bytes(r["kept"])) for r in found.collect()) == cut_by_hand(ROWS)
    assert suffix_dedup.without_repeats(none).count() == 0


def test_suffix_dedup_cuts_heavy_keys(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HEAVY", 2)
    monkeypatch.setattr(suffix_dedup, "GROUP", 1 << 12)
    monkeypatch.setattr(suffix_dedup, "SHARD", 1 << 10)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 10)
    monkeypatch.setattr(suffix_dedup, "LONGEST", 200)
    assert Counter((*r[:5], bytes(r["kept"])) for r in suffix_dedup.without_repeats(docs).collect()) == cut_by_hand(ROWS)


def test_suffix_dedup_deals_a_common_phrase_by_its_surroundings(spark, monkeypatch):
    phrase = "In, of the inanin. Thonst aonthrein thedtiou anon. "
    rows = [(k, prose(100 + k, 6) + phrase[: 50 - k % 3] + prose(200 + k % 40, 6), "de", 1) for k in range(120)]
    rows += [(500 + k, phrase[:44] + prose(300 + k, 12), "de", 1) for k in range(60)]
    monkeypatch.setattr(suffix_dedup, "HEAVY", 8)
    monkeypatch.setattr(suffix_dedup, "HEAVIEST", 8)
    found = suffix_dedup.without_repeats(make(spark, rows)).collect()
    assert Counter((*r[:5], bytes(r["kept"])) for r in found) == cut_by_hand(rows)
    assert sum(r["n_removed"] > 0 for r in found) > 100
    # a segment is at most one piece for each window: before, it was one for each start
    key, text = suffix_dedup._gram_hashes(b"0123456789abcdef").view(np.int64)[0].item(), bytes(range(34)) + b"0123456789abcdef" + bytes(range(60, 94))
    one = spark.createDataFrame([(key, 7, 1, 2, 3, text)], "key long, part long, first long, last long, offset long, segment binary")
    pieces = suffix_dedup._in_pieces(one, suffix_dedup._by_window(50), 50).collect()
    assert len(pieces) == 4 and len({r["sub"] for r in pieces}) == 4
    spans = sorted((r["offset"] - 3, r["offset"] - 3 + len(r["segment"]) - 49) for r in pieces)
    assert spans[0][0] == 0 and spans[-1][1] == 35 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert all(text[r["offset"] - 3 :].startswith(bytes(r["segment"])) for r in pieces)


def test_suffix_dedup_filter_grows_with_the_keys(spark):
    keys = spark.range(8_000_000).select(F.xxhash64("id").alias("key"))
    others = spark.range(8_000_000, 8_400_000).select(F.xxhash64("id").alias("key"), "id", F.lit(1).cast("long").alias("own"), F.lit(b"").alias("segment"))
    rows = others.withColumnRenamed("id", "part").unionByName(keys.limit(1_000).selectExpr("key", "0L as part", "1L as own", "cast('' as binary) as segment"))
    passed = suffix_dedup._of_keys(rows, keys)
    assert passed.filter("part = 0").count() == 1_000
    assert passed.filter("part > 0").count() < 0.07 * 400_000  # 0.11 in one bitmap of 8 MB


def test_interleave_leaves_out_rows_that_cannot_end():
    strings = [b"abcde" * 4, b"xabcdeabcdeabcdex", b"abcdeabcde"]
    string, offset, _ = interleave.repeated(strings, 10, 2)
    times = Counter(s[i : i + 10] for s in strings for i in range(len(s) - 9))
    assert set(zip(string.tolist(), offset.tolist())) == {(j, i) for j, s in enumerate(strings) for i in range(len(s) - 9) if times[s[i : i + 10]] > 1}
    letters = np.frombuffer(bytes([interleave.END]).join([*strings, b""]), dtype=np.uint8)
    shard, none = interleave.transform(letters, interleave.rotation_order(letters)), np.zeros(len(letters), dtype=bool)
    assert [len(x) for x in interleave.merged([shard], 10, [none])] == [0, 0]


def test_suffix_dedup_query(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op11_suffix_dedup"](spark, FOLDER)
    assert Counter(tuple(r) for r in found.collect()) == Counter(r[:5] for r in cut_by_hand(data).elements())


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_interleave_finds_repeats(shards):
    draw = random.Random(shards)
    for alphabet in (b"ab", b"abcd", bytes(range(255))):
        strings = [bytes(draw.choice(alphabet) for _ in range(draw.randrange(40))) for _ in range(15)]
        strings += strings[:2]
        windows = [(j, i, s[i : i + 6]) for j, s in enumerate(strings) for i in range(len(s) - 5)]
        times = Counter(w for *_, w in windows)
        string, offset, interval = (x.tolist() for x in interleave.repeated(strings, 6, shards))
        text = {(j, i): w for j, i, w in windows}
        assert set(zip(string, offset)) == {(j, i) for j, i, w in windows if times[w] > 1}
        named = defaultdict(set)
        for j, i, x in zip(string, offset, interval):
            named[x].add(text[j, i])
        assert all(len(w) == 1 for w in named.values()) and len(named) == sum(n > 1 for n in times.values())


def test_transform_is_invertible():
    letters = np.frombuffer(b"banana bandana" + bytes([interleave.END]), dtype=np.uint8)
    order = interleave.rotation_order(letters)
    before, moved = interleave.transform(letters, order)
    row, text = int(np.flatnonzero(order == 0)[0]), []
    for _ in letters:
        text.append(int(before[row]))
        row = int(moved[row])
    assert bytes(text[::-1]) == letters.tobytes()


# --- importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, lengths):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(lengths[0], lengths[1] + 1) for i in range(len(words) - n + 1)]


def drawn_by_hand(rows, target, lengths, buckets=10_000, least=20, percent=10):
    def bucket(gram):
        return zlib.crc32(gram.encode()) % buckets

    own = [(k, *features(t, lengths)) for k, t, *_ in rows]
    have, want = Counter(), Counter()
    for _, _, grams in own:
        have.update(map(bucket, grams))
    for text in target:
        want.update(map(bucket, features(text, lengths)[1]))
    s, t = sum(have.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets)))) for b in range(buckets)]
    scored = []
    for k, words, grams in own:
        weight = sum(gain[bucket(g)] for g in grams)
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        scored.append((k, words, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    take = able[: len(able) * percent // 100]
    return Counter((*x, i + 1) for i, x in enumerate(take)) + Counter((*x, None) for x in able[len(take) :]) + Counter((*x, None) for x in scored if x[1] < least)


@pytest.mark.parametrize("lengths", [(1, 1), (1, 3), (2, 2)])
def test_importance_by_hand(spark, docs, lengths, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 1_000)  # texts of many pieces
    target = [SHARED, prose(77, 60), None, "", "Rain falls. ON old-stone"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resampled(docs, frame, lengths=lengths, percent=40)
    assert Counter(tuple(r) for r in found.collect()) == drawn_by_hand(ROWS, target, lengths, percent=40)


def test_importance_empty_tables(spark, docs, none):
    nothing = spark.createDataFrame([], "text string")
    assert importance.resampled(none, nothing).count() == 0
    found = importance.resampled(docs, nothing, lengths=(1, 1), percent=100)
    assert Counter(tuple(r) for r in found.collect()) == drawn_by_hand(ROWS, [], (1, 1), percent=100)


def test_importance_query(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("text").collect()]
    found = queries.QUERIES["op12_importance"](spark, FOLDER)
    want = Counter((k, n, w, s, r) for k, _, n, w, s, r in drawn_by_hand(data, target, (1, 1)).elements())
    assert Counter(tuple(r) for r in found.collect()) == want


def test_gram_table_compares_bytes(monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda gram: len(gram) % 2)  # almost all hashes collide
    draw = random.Random(2)
    grams = [b"w%d" % draw.randrange(40) for _ in range(500)]
    made = importance.GramTable(grams, 1_000)
    want = Counter(zlib.crc32(g) % 1_000 for g in grams)
    assert {int(b): int(n) for b, n in enumerate(made.bucket_counts()) if n} == dict(want)
    gains = np.arange(1_000) * 7
    assert made.gathered(gains).tolist() == [zlib.crc32(g) % 1_000 * 7 for g in grams]
    assert len(made.used) == len(set(grams))


# --- Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(leaves, arity):
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([digest("".join(rows[-1][i : i + arity])) for i in range(0, len(rows[-1]), arity)])
    return rows


def steps(rows, place, arity):
    out = []
    for row in rows[:-1]:
        start = place // arity * arity
        out.append(("".join(row[start:place]), "".join(row[place + 1 : start + arity])))
        place //= arity
    return out


def manifest_by_hand(rows, arity):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, digest("".join(map(field, r))), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels([x[2] for x in groups[g]], arity)
    top = levels([trees[g][-1][0] for g in names], arity)
    root, out = top[-1][0], []
    for i, g in enumerate(names):
        for place, (_, _, leaf, r) in enumerate(groups[g]):
            path = steps(trees[g], place, arity) + steps(top, i, arity)
            changed = list(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                changed[3] += 1
            node = digest("".join(map(field, changed)))
            for left, right in path:
                node = digest(left + node + right)
            out.append((r[0], leaf, trees[g][-1][0], root, digest("".join(a + b for a, b in path)), node, node == root))
    return Counter(out)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize(("arity", "block"), [(2, 256), (2, 4), (3, 9), (5, 5)])
def test_merkle_by_hand(docs, arity, block, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", block)  # small blocks: several storeys
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claims = {"n_chars": F.when(bad, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    made = merkle.verified(merkle.manifest(docs, columns=COLUMNS, id_col="doc_id", group_col="lang", arity=arity, claims=claims))
    found = made.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    rows = [(k, None if n is None else f"s{n % 3}", g, n, t) for k, t, g, n in ROWS]
    want = manifest_by_hand(rows, arity)
    # equal rows of one id may take each other's place in the tree, so all else is compared
    assert Counter(tuple(r) for r in found) == want


def test_merkle_empty_and_single(spark, none):
    options = {"columns": COLUMNS, "id_col": "doc_id", "group_col": "lang"}
    assert merkle.verified(merkle.manifest(none, **options)).count() == 0
    one = merkle.verified(merkle.manifest(make(spark, [(5, "t", None, 1)]), **options)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"]
    assert one["proof_sha256"] == digest("")


def test_merkle_query(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(*COLUMNS).collect()]
    found = queries.QUERIES["op13_merkle"](spark, FOLDER)
    assert Counter(tuple(r) for r in found.collect()) == manifest_by_hand(data, 2)
