"""Registered queries and the whole pipeline on a folder of odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from urbanloom.llm.queries import QUERIES

SYLLABLES = "ri ver sto ne li ght un der gre en hi ll ro ad le tter win ter gar den so ng bre ad pa per clo ck fi eld".split()
WORDS = ["".join(random.Random(k).choices(SYLLABLES, k=1 + k % 4)) for k in range(3_000)]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + (str(draw.randrange(40)) if draw.random() < 0.5 else "") for _ in range(n))


LONG = prose(3, 20_000)
NEAR = prose(50, 200).split()
DOCUMENTS = [
    (1, prose(1, 150), "en", "a"), (2, None, None, None), (3, "", "de", "b"), (4, " \n\t", "de", ""), (5, prose(1, 150), "en", "a"),
    (5, prose(1, 150), "en", "a"), (6, "Straße naïve Ω it's <|endoftext|> " * 9, "de", None), (7, LONG, "en", "a"),
    (8, "spam " * 400, "fr", "b"), (9, " ".join(NEAR), "en", "b"), (10, " ".join([*NEAR[:100], "changed", *NEAR[101:]]), "en", "c"),
    (None, prose(9, 60), "en", "c"), (12, prose(12, 90) + "\n" + prose(13, 60), "en", "c"), (13, prose(13, 60), "en", "a"),
]
PAGES = [(1, "u", "<p>x</p>"), (2, "v", None), (3, "u", "<p>x</p>"), (4, "w", ""), (5, None, "é" * 90_000), (6, "v", None)]
VECTORS = [(1, [1.0, 0.0, 2.0], 1), (2, [2.0, 0.0, 4.0], 1), (3, [0.0, 1.0, 0.0], 1), (4, None, 1), (5, [1.0, 0.0, 2.0], None), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, 0.0, 2.0], 0)]
BENCHMARK = [(1, prose(1, 40)), (2, None), (3, "")]


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param))
    full = request.param == "odd"
    tables = {
        "documents": ([(k, t, g, s, None if t is None else len(t)) for k, t, g, s in DOCUMENTS], "doc_id long, text string, lang string, source string, n_chars long"),
        "pages": (PAGES, "page_id long, url string, html string"),
        "embeddings": (VECTORS, "vec_id long, embedding array<double>, label int"),
        "benchmark": (BENCHMARK, "item_id long, text string"),
        "labels": ([(1, 1, 0), (8, 0, 0), (12, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in tables.items():
        extra = "id string, text_hash long, rank long, __ul string"  # columns nobody asked for
        frame = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows] if full else [], f"{schema}, {extra}")
        frame.write.parquet(f"{path}/{name}.parquet")
    return path, full


def shown(text):
    return text or ""


def encoding():
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(codec, text):
    ids = codec.encode_ordinary(shown(text))
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(shown(text).encode()).hexdigest()


@pytest.mark.parametrize("name", [q for q in QUERIES if q != "pipeline"])
def test_every_row_has_a_result(spark, folder, name):
    path, full = folder
    found = QUERIES[name](spark, path).collect()
    rows = {"op5_cover_tree": VECTORS, "op10_warc": PAGES}.get(name, DOCUMENTS)
    assert len(found) == (len(rows) if full else 0)
    if full:
        key = {"op5_cover_tree": "vec_id", "op10_warc": "page_id"}.get(name, "doc_id")
        assert Counter(r[key] for r in found) == Counter(r[0] for r in rows)


def test_contracts_on_odd_rows(spark, folder):
    path, full = folder
    if not full:
        return
    codec = encoding()
    want = Counter((k, *coded(codec, t)) for k, t, *_ in DOCUMENTS)
    assert Counter(tuple(r) for r in QUERIES["op4_byte_bpe"](spark, path).collect()) == want
    pages = {r["page_id"]: r for r in QUERIES["op10_warc"](spark, path).collect()}
    last = {shown(h): k for k, _, h in PAGES}
    for k, _, html in PAGES:
        first = last[shown(html)] == k
        assert pages[k]["record_type"] == ("response" if first else "revisit")
        assert pages[k]["refers_to"] == (None if first else last[shown(html)]) and pages[k]["payload_bytes"] == len(shown(html).encode())
    vectors = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in QUERIES["op5_cover_tree"](spark, path).collect()}
    assert vectors == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (0, 6, True), 7: (0, 7, True)}
    held = {r["doc_id"]: r["held_out"] for r in QUERIES["op7_quality_model"](spark, path).collect() if r["doc_id"]}
    assert held == {k: zlib.crc32(str(k).encode()) % 3 == 1 for k, *_ in DOCUMENTS if k}
    mix = QUERIES["op3_mixing"](spark, path).collect()
    sizes = Counter((k, len(shown(t).encode().split())) for k, t, *_ in DOCUMENTS)
    assert Counter((r["doc_id"], r["size"]) for r in mix) == sizes
    assert all(r["taken"] <= 3 * r["size"] for r in mix)
    near = {r["doc_id"]: r["component_id"] for r in QUERIES["op9_lsh_forest"](spark, path).collect() if r["doc_id"]}
    assert near[10] == near[9] == 9 and near[5] == near[1] == 1


def shingles(text):
    words = shown(text).encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_as_a_whole(spark, folder):
    path, full = folder
    found = corpus_pipeline.run(spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, path)
    kept = [(r["doc_id"], r["text"]) for r in docs.collect()]
    if not full:
        assert found == kept == []
        return
    sets = [shingles(t) for _, t in kept]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or 100 * len(a & b) < 80 * len(a | b)
    given = {k for k, *_ in DOCUMENTS}
    assert {k for k, _ in kept} <= given and 8 not in {k for k, _ in kept}
    assert {1, 7, 9} <= {k for k, _ in kept} and not {5, 10} & {k for k, t in kept if shingles(t)}
    codec = encoding()
    could = {(k, *coded(codec, t)) for k, t in kept}
    times = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found)
    assert set(times) <= could and max(times.values()) <= 3
    assert Counter(tuple(r) for r in QUERIES["pipeline"](spark, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == times
