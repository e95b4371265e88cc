"""The operators on small tables, against brute force, with the odd rows they must bear."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from urbanloom.llm import (
    byte_bpe,
    cover_tree,
    line_dedup,
    lsh_forest,
    mixing,
    quality_model,
    quality_rules,
    surrogates,
    token_files,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id string, size long, component_id long"
PROSE = "the quick brown fox jumps over one lazy dog and then another while rain falls on old stone".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(PROSE) + str(draw.randrange(60)) for _ in range(words))


LONG = prose(9, 30_000)
TEXTS = {
    1: prose(1, 120),
    2: None,
    3: "",
    4: " \n\t ",
    5: prose(1, 120),
    6: prose(2, 60) + "\n" + prose(3, 55) + "\n\n" + prose(4, 10),
    7: "an opening line\n" + prose(2, 60) + "\n" + prose(3, 55) + "\nown end",
    8: LONG,
    9: "Straße  naïve Ω ’s it's 123 <|endoftext|> 　\x1c end ",
    10: "spam spam " * 40,
}


def rows(texts=TEXTS):
    return [(k, t, None, ["a", "b", None][k % 3], 0, "x", 7, 8) for k, t in texts.items()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def test_token_files_round_trip(spark, docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    options = {"tokenizer": path, "end_id": 2}
    found = token_files.token_files(docs, **options).orderBy("start").collect()
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(path), 0
    for row, (key, text) in zip(found, sorted(TEXTS.items()), strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        assert (row["id"], row["start"], row["n_tokens"]) == (key, start, len(ids) // 4)
        assert row["ids"] == ids and row["ids_crc32"] == zlib.crc32(ids)
        start += row["n_tokens"]
    assert token_files.token_files(none, **options).count() == 0


@pytest.mark.parametrize("counts", [[1], [5, 5], [1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89], [1] * 300])
def test_code_lengths_keep_the_limit(counts):
    limit = max(9, 4)
    lengths = token_files.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and sum(2.0 ** -int(n) for n in lengths) <= 1
    codec = token_files.Codec(np.arange(len(counts)), lengths, limit)
    ids = np.random.default_rng(1).integers(0, len(counts), 1_000)
    bits, marks = codec.encode(ids)
    lanes = np.diff([*range(0, 1_000, token_files.STEP), 1_000])
    assert (codec.decode(np.frombuffer(bits, dtype=np.uint8), marks, lanes) == ids).all()


def test_documents_coded_together_are_those_coded_alone():
    rng = np.random.default_rng(1)
    lengths = token_files.code_lengths(rng.zipf(1.3, 5000).astype(float), 18)
    codec, numbers = token_files.Codec(np.arange(5000), lengths, 18), np.array([1, 1, 2, 300, 0, 256, 257, 4000, 1])
    ids, ends = rng.integers(0, 5000, numbers.sum()), np.cumsum(numbers)
    for n, end, (bits, marks) in zip(numbers, ends, codec.encode_each(ids, numbers)):
        alone, at = codec.encode(ids[end - n : end])
        assert bits == alone and marks.tolist() == at.tolist()
        own = -(-n // token_files.STEP)
        lanes = np.minimum(token_files.STEP, n - token_files.STEP * np.arange(own))
        assert codec.decode(np.frombuffer(bits, dtype=np.uint8), marks, lanes).tolist() == ids[end - n : end].tolist()


def test_byte_bpe_equals_the_merge_rules(docs, none):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    options = {"ranks": path, "pattern": public_tokenizers.PATTERN}
    ranks = byte_bpe.load_ranks(path)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for row in byte_bpe.encode_documents(docs, **options).collect():
        text = TEXTS[row["id"]] or ""
        ids = np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()
        assert row["ids"] == ids and row["n_tokens"] == len(ids) // 4
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encode_documents(none, **options).count() == 0


def test_byte_bpe_on_random_strings():
    import tiktoken

    pairs = byte_bpe.byte_pairs(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})
    draw = random.Random(3)
    for _ in range(3_000):
        text = "".join(draw.choice("ab  \n\t's'll é1Σ́　😀eeth.,=") for _ in range(draw.randrange(40)))
        assert np.frombuffer(pairs.encode(text), "<u4").tolist() == plain.encode_ordinary(text), repr(text)


def test_mixing(docs, none, spark):
    found = mixing.mix(docs).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(TEXTS)
    sizes = {k: len(words(t)) for k, t in TEXTS.items()}
    taken, targets = {}, {}
    for r in found:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        targets[r["source"]] = r["target"]
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    assert set(taken) == {"a", "b", None}
    again = mixing.mix(docs).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in found) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert mixing.mix(none).count() == 0
    assert set(mixing.mixed_documents(docs).columns) == set(docs.columns)


@pytest.mark.parametrize("budget", [0, 1, 17, 99, 1_000, 5_000, 10_000])
def test_choose_counts_meets_the_budget(budget):
    sizes, counts = [3, 7, 11, 40, 900], [5, 100, 3, 20, 9]
    for room in (50, 65_536):
        taken = mixing.choose_counts(sizes, counts, budget, room)
        total = sum(s * n for s, n in zip(sizes, taken))
        assert all(0 <= n <= c for n, c in zip(taken, counts)) and total <= budget
        if budget > 20:
            assert budget - total <= 2 or total == sum(s * n for s, n in zip(sizes, counts))


def test_line_dedup_against_brute_force(docs, none, spark):
    texts = TEXTS | {11: TEXTS[6], 12: "x1 x2\n" * 80}
    frame = spark.createDataFrame(rows(texts) + rows({12: texts[12]}), SCHEMA)
    lines = {k: [(i, x, len(words(x))) for i, x in enumerate((t or "").split("\n")) if words(x)] for k, t in texts.items()}

    def windows(key):
        for way in (1, -1):
            for i in range(len(lines[key])):
                total, j = 0, i
                while 0 <= j < len(lines[key]):
                    total += lines[key][j][2]
                    if total >= 50:
                        own = lines[key][min(i, j) : max(i, j) + 1]
                        yield tuple(x for _, x, _ in own), (key, own[0][0]), own[-1][0]
                        break
                    j += way

    first = {}
    for key in texts:
        for content, place, _ in windows(key):
            first[content] = min(place, first.get(content, place))
    for row in line_dedup.without_repeats(frame, counts=True).collect():
        key, text = row["doc_id"], texts[row["doc_id"]]
        cut = {n for c, p, last in windows(key) if first[c] != p for n in range(p[1], last + 1)}
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in cut)
        assert row["text"] == kept and row["n_removed"] == len(cut)
    assert line_dedup.without_repeats(frame).count() == len(texts) + 1
    assert line_dedup.without_repeats(none).count() == 0


def near_fixture():
    base, texts = prose(20, 150).split(), {}
    for k in range(60):
        draw, own = random.Random(k), list(base)
        for _ in range(k % 9):
            own[draw.randrange(len(own))] = f"changed{draw.randrange(50)}"
        texts[100 + k] = " ".join(own)
    return texts | {1: "a b", 2: "A  B", 3: None, 4: "", 5: "the same four words", 6: "other text here now", 7: LONG, 8: LONG + " x"}


def test_near_duplicates_against_all_pairs(spark, none):
    texts = near_fixture()
    frame = spark.createDataFrame(rows(texts), SCHEMA)
    sets = {}
    for k, t in texts.items():
        w = [x.lower() for x in words(t)]
        sets[k] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    found = lsh_forest.near_duplicates(frame, words=4).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root(r["doc_id"])), r
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert lsh_forest.near_duplicates(none).count() == 0


def test_dense_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "LEAF", 2)
    monkeypatch.setattr(lsh_forest, "BLOCK", 7)
    test_near_duplicates_against_all_pairs(spark, spark.createDataFrame([], SCHEMA))


def test_near_vectors_of_odd_ids_and_sizes(spark):
    data = [
        (1, [1.0, 2.0, 3.0], 1), (None, [1.0, 2.0, 3.001], 1), (None, [5.0, 0.0, 0.0], 1),
        (5, [0.0, 1.0, 0.0], 2), (5, [1.0, 0.0, 0.0], 2), (6, [1.0, 0.001, 0.0], 2),
        (7, [1e200, 2e200, 0.0], 3), (8, [3e200, 6e200, 0.0], 3), (9, [1e-200, 2e-200, 0.0], 3),
    ]
    frame = spark.createDataFrame([(*r, 1, 2) for r in data], "vec_id long, embedding array<double>, label int, owner int, low int")
    found = sorted((tuple(r) for r in cover_tree.near_vectors(frame).collect()), key=str)
    assert found == sorted(
        [
            (1, 1, 1, True), (None, 1, 1, False), (None, 0, None, True), (5, 0, 5, True), (5, 1, 5, True), (6, 1, 5, False),
            (7, 2, 7, True), (8, 2, 7, False), (9, 2, 7, False),
        ],
        key=str,
    )


def test_near_vectors_split_labels_without_pivots(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "PIVOTS", 2)  # one label gets pivots, the other none
    test_near_vectors_against_all_pairs(spark, monkeypatch, 20)


@pytest.mark.parametrize("cell", [8_192, 20])
def test_near_vectors_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(cover_tree, "CELL", cell)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 8))
    table = [(k, (centres[k % 12] + draw.normal(size=8) * 0.12).tolist(), k % 2) for k in range(150)]
    table += [(200, table[0][1], 0), (201, None, 0), (202, [0.0] * 8, 0), (203, table[0][1], None), (204, [float("nan")] * 8, 0)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    usable = [r for r in table if r[0] <= 200]
    links, parent = {r[0]: 0 for r in table}, {r[0]: r[0] for r in table}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (a, x, p) in enumerate(usable):
        for b, y, q in usable[i + 1 :]:
            x_, y_ = np.array(x), np.array(y)
            if p == q and x_ @ y_ / (np.linalg.norm(x_) * np.linalg.norm(y_)) >= 0.98:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    found = cover_tree.near_vectors(frame).collect()
    assert len(found) == len(table) and sum(links.values()) > 0
    for r in found:
        assert (r["n_links"], r["component_id"]) == (links[r["vec_id"]], root(r["vec_id"])), r
    assert cover_tree.near_vectors(frame.limit(0)).count() == 0


def test_quality_rules(docs, none):
    found = {r["id"]: r for r in quality_rules.judge(docs).collect()}
    for k, text in TEXTS.items():
        w, r = words(text), found[k]
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        again = {i + d for i, x in enumerate(windows) if windows.count(x) > 1 for d in range(8)} if len(w) < 500 else set()
        assert r["n_words"] == len(w) and r["n_repeat_words"] == len(again)
        assert r["word_chars"] == sum(len(x.decode()) for x in w)
        assert r["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert found[1]["kept"] and not found[10]["kept"]
    assert quality_rules.judge(none).count() == 0
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, r in found.items() if r["kept"]}


def test_quality_model_separates_held_out_rows(spark, none):
    texts = {k: prose(k, 80) if k % 3 else "BUY NOW!! " * 30 + prose(k, 20).upper() for k in range(240)}
    frame = spark.createDataFrame(rows(texts | {999: None}), SCHEMA)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in texts] + [(5_000, 1), (1, None)], "doc_id long, quality int")
    found = quality_model.scored(frame, labels, F.col("doc_id") < 160).collect()
    assert len(found) == 241 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["id"] % 3 > 0) for r in found if 160 <= r["id"] < 240)
    assert quality_model.scored(none, labels, F.lit(True)).count() == 0


def test_quality_model_rows_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "fit", lambda rows, labels: (_ for _ in ()).throw(AssertionError(f"rows={len(rows)} labels={sorted(set(labels.tolist()))}")))
    texts = [(1, f"row {k} of one id") for k in range(300)] + [(1, "the same")] * 50 + [(k, "one text") for k in range(2, 40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)] + [(1, 0), (3, 0)], "doc_id long, quality int")
    for bound, want in ((100, 100), (10_000, 339)):
        with pytest.raises(Exception, match=f"rows={want} "):
            quality_model.scored(docs, labels, F.lit(True), max_rows=bound).collect()


def test_surrogates(spark, none):
    texts = {
        1: "Mail Ana.Lo@host.example.com or 10.2.3.4, card 4111 1111 1111 1111, key " + "0a" * 20,
        2: "ana.lo@host.example.com; +1 (017) 555-7713 / Frau Anna Schmidt, г-н Иванов",
        3: None,
        4: "",
        5: "4111-1111-1111-1111 and Frau Anna Schmidt",
        6: "version 1.2 of 2024",
    }
    frame = spark.createDataFrame(rows(texts) + rows({1: texts[1]}), SCHEMA)
    out = {r["doc_id"]: r for r in surrogates.replaced(frame, key="k", counts=True).collect()}
    assert [out[k]["n_entities"] for k in sorted(out)] == [4, 4, 0, 0, 2, 0]
    assert out[3]["text"] is None and out[4]["text"] == "" and out[6]["text"] == texts[6]
    for secret in ("host.example.com", "10.2.3.4", "1111", "0a0a", "017", "7713", "Schmidt", "Иванов"):
        assert not any(secret in (r["text"] or "") for r in out.values())
    mail = out[1]["text"].split()[1]
    assert out[2]["text"].startswith(mail + ";")
    card = "".join(filter(str.isdigit, out[5]["text"]))
    assert card in out[1]["text"].replace(" ", "") and out[5]["text"][4] == "-"
    assert out[2]["text"].split("Frau ")[1].split(",")[0] == out[5]["text"].split("Frau ")[1]
    assert "+1 (0" in out[2]["text"]
    assert surrogates.replaced(none, key="k").count() == 0
    assert surrogates.replaced(frame, key="k").count() == 7


def test_surrogates_stay_distinct(spark):
    entities = spark.createDataFrame([("phone", f"|{k:02d}") for k in range(60)], "kind string, canonical string")
    with_free = surrogates.surrogate_table(entities.filter("canonical < '|30'"), "k").collect()
    assert len({r["surrogate"] for r in with_free}) == 30
    assert not {r["surrogate"] for r in with_free} & {r["canonical"] for r in with_free}


def test_surrogates_of_used_up_formats(spark):
    entities = spark.createDataFrame([("phone", f"|{k:02d}") for k in range(100)], "kind string, canonical string")
    found = surrogates.surrogate_table(entities, "k").collect()
    assert len({r["surrogate"] for r in found}) == 100  # no two digits are free, so they get longer
    assert not {r["surrogate"] for r in found} & {r["canonical"] for r in found}
    value = spark.range(1).select(surrogates._noted(F.lit("phone"), F.lit("(01) 23"), F.lit("|987654")).alias("v"))
    assert value.first()["v"] == "(98) 7654"


def test_surrogates_bear_long_runs(spark):
    texts = {1: "a@" + "b." * 50_000, 2: "x" * 1_000_000, 3: "." * 100_000, 4: "a." * 40_000 + "@", 5: "to a@b.co."}
    frame = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    begin = time.perf_counter()
    out = {r["doc_id"]: r for r in surrogates.replaced(frame, key="k", counts=True).collect()}
    assert time.perf_counter() - begin < 60
    assert [out[k]["n_entities"] for k in sorted(out)] == [1, 0, 0, 0, 1]
    assert out[5]["text"].startswith("to ") and out[5]["text"].endswith(".example.") and out[2]["text"] == texts[2]


def test_token_files_of_another_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    plain = Tokenizer(models.BPE(vocab=letters | {"th": 26, "the": 27}, merges=[("t", "h"), ("th", "e")]))
    plain.pre_tokenizer = pre_tokenizers.Whitespace()
    plain.save(str(tmp_path / "plain.json"))
    texts = {1: "the cat", 2: "The THE there", 3: None, 4: "tthhee bathe"}
    frame = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    found = token_files.token_files(frame, tokenizer=str(tmp_path / "plain.json"), end_id=2, vocabulary=28).collect()
    for r in found:
        want = [*plain.encode(texts[r["id"]] or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == want


def test_token_files_of_repeated_ids(spark):
    rows_ = [(None, "b"), (None, "a a"), (7, "x"), (7, "x"), (7, "y z"), (None, "b")]
    frame = spark.createDataFrame(rows_, "doc_id long, text string")
    options = {"tokenizer": public_tokenizers.path("word_bpe_49k.json"), "end_id": 2}
    found = token_files.token_files(frame, **options).orderBy("start").collect()
    assert [r["id"] for r in found] == [None] * 3 + [7] * 3
    ends = [r["start"] + r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [0, *ends[:-1]]


def test_warc_round_trip(spark):
    pages = [(1, "u", "<p>x</p>"), (2, "u v", "<p>é</p>"), (3, None, "<p>x</p>"), (4, "u", None), (5, "u", ""), (6, "u", "<p>x</p>"), (None, "u", "y" * 200_000)]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    found = {r["page_id"]: r for r in warc.archived(frame).collect()}
    assert len(found) == 7 and all(r["verified"] for r in found.values())
    for page, _, html in pages:
        raw = (html or "").encode()
        assert found[page]["payload_bytes"] == len(raw) and found[page]["payload_digest"] == warc.sha1_base32(raw)
        assert found[page]["payload"] == (raw if found[page]["record_type"] == "response" else None)
    assert {k: r["refers_to"] for k, r in found.items()} == {1: 6, 2: None, 3: 6, 4: 5, 5: None, 6: None, None: None}
    assert warc.archived(frame.limit(0)).count() == 0


def test_warc_reader_finds_damage():
    import io

    data = warc.record(1, "u", b"abc")
    assert warc.parse(data)["verified"] and not warc.parse(data.replace(b"abc", b"abd"))["verified"]
    assert not warc.parse(data[:-6])["verified"]
    whole = warc.gzip_member(data) * 2
    assert list(warc.members(io.BytesIO(whole))) == [data, data]
    with pytest.raises(EOFError):
        list(warc.members(io.BytesIO(whole[:-9])))


def test_mix_counts_repeated_rows_and_null_ids_by_row(spark):
    """A third of a source has no id, another third repeats two rows; each row has its own repeats."""
    data = [(k, prose(k, 40), "a") for k in range(40)]
    data += [(None, prose(100 + k, 40), "a") for k in range(40)] + [(7, prose(7, 40), "a")] * 20 + [(None, prose(3, 40), "a")] * 20
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    for options in ({"share": 0.5}, {"share": 1.9}):
        plan = mixing.mix(frame, **options).collect()
        mixed = mixing.mixed_documents(frame.repartition(3), **options).collect()
        target = plan[0]["target"]
        assert sum(r["taken"] for r in plan) == 40 * len(mixed) and target - 40 < 40 * len(mixed) <= target
        by_plan, by_rows = Counter(), Counter(r["doc_id"] for r in mixed)
        for r in plan:
            by_plan[r["doc_id"]] += r["repeats"]
        assert +by_plan == by_rows


def test_mix_ranks_copies_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    frame = spark.createDataFrame([(None, "one two", None)] * 30 + [(1, "one two", None)], "doc_id long, text string, source string")
    assert mixing.mixed_documents(frame, share=0.5).count() == 15


def test_near_duplicates_keep_one_row_per_class(spark):
    one, two, three = prose(1, 80), prose(2, 80), prose(3, 80)
    data = [(5, one), (5, one), (5, two), (3, two), (None, two), (None, three), (None, three), (None, prose(4, 80)), (8, ""), (None, None)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in lsh_forest.kept_documents(frame).collect()]
    assert Counter(kept) == Counter([(5, one), (3, two), (None, three), (None, prose(4, 80)), (8, ""), (None, None)])


def test_choose_counts_draws_all_sizes():
    draw = random.Random(4)
    sizes = draw.sample(range(20, 2_000), 500)
    middle = sorted(sizes)[250]
    for budget in (20_000, 70_000, 200_000):
        picks = [mixing.choose_counts(sizes, [1] * 500, budget, seed=seed) for seed in (1, 2)]
        assert picks[0] != picks[1] and picks[0] == mixing.choose_counts(sizes, [1] * 500, budget, seed=1)
        for taken in picks:
            assert sum(s * n for s, n in zip(sizes, taken)) == budget
            small = sum(n for s, n in zip(sizes, taken) if s < middle)
            assert 0.25 * sum(taken) < small < 0.75 * sum(taken)


@pytest.mark.parametrize("sizes, counts, budget", [([5, 50], [9, 3], 10), ([90, 91, 99], [40, 40, 40], 997), ([2, 4, 70_000], [8, 8, 2], 70_031), ([0, 3], [4, 4], 6)])
def test_choose_counts_stays_as_near(sizes, counts, budget):
    reach = {0}
    for s, n in zip(sizes, counts):
        reach = {r + s * k for r in reach for k in range(n + 1)}
    taken = mixing.choose_counts(sizes, counts, budget)
    assert sum(s * n for s, n in zip(sizes, taken)) == max(r for r in reach if r <= budget)


def test_surrogates_leave_digits_that_fail_luhn(spark):
    texts = {
        1: "order 1234 5678 9012 3456 of today",
        2: "1234567890123456 and 4111-1111-1111-1111, then 4111 1111 1111 1112 / me@host.example.com",
        3: "4111111111111111",
    }
    frame = spark.createDataFrame(rows(texts), SCHEMA)
    out = {r["doc_id"]: r for r in surrogates.replaced(frame, key="k", counts=True).collect()}
    assert [out[k]["n_entities"] for k in (1, 2, 3)] == [0, 2, 1]
    assert out[1]["text"] == texts[1]
    assert out[2]["text"].startswith("1234567890123456 and ") and ", then 4111 1111 1111 1112 / " in out[2]["text"]
    assert "host" not in out[2]["text"] and "4111-1111-1111-1111" not in out[2]["text"]
    assert out[3]["text"] == out[2]["text"][21:40].replace("-", "") != texts[3]


def test_visible_ascii_runs_are_cut_as_the_library_cuts_them(monkeypatch):
    from array import array

    import public_tokenizers
    from tokenizers import Tokenizer

    from urbanloom.llm import token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["a1b2", "DON'T I'LL we'RE'S", "''s'", "it's're1d", "x<|endoftext|>'s", "a--b/c.d 10:45", "<|StartOfText|>"]
    expected = [array("H", [*library.encode(t, add_special_tokens=False).ids, 2]).tobytes() for t in texts]
    whole, wholes = token_files._Runs.whole, []
    monkeypatch.setattr(token_files._Runs, "whole", lambda self, run: wholes.append(run) or whole(self, run))
    token_files._runs.cache_clear()
    assert token_files.encode_texts(texts, path, 2, "<u2", True) == expected
    assert wholes == ["x<|endoftext|>'s"]  # only what holds a token of its own takes all steps


def test_runs_of_a_slice_are_coded_once_and_put_in_place(monkeypatch):
    from array import array

    import public_tokenizers
    from tokenizers import Tokenizer

    from urbanloom.llm import token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["one two three four five six seven " * 20, "", " \n", "Six,\tone.\x0bTWO!!!!\x0cthree", "é\xa0Été　中文 x", "a\x1cb \x1f", "\xa0", "\x85"]
    expected = [array("H", [*library.encode(t, add_special_tokens=False).ids, 2]).tobytes() for t in texts]
    monkeypatch.setattr(token_files, "ROOM", 2)  # the memory of words forgets at once
    compute, computed = token_files._Pieces.compute, []
    monkeypatch.setattr(token_files._Pieces, "compute", lambda self, piece: computed.append(piece) or compute(self, piece))
    token_files._runs.cache_clear()
    assert token_files.encode_texts(texts[:1], path, 2, "<u2", True) == expected[:1]
    assert sorted(computed) == sorted(texts[0].split()[:7])
    assert token_files.encode_texts(texts, path, 2, "<u2", True) == expected
    for size in (1, 30):
        monkeypatch.setattr(token_files, "SLICE", size)
        assert token_files.encode_texts(texts, path, 2, "<u2", True) == expected
    assert token_files.encode_texts([], path, 2, "<u2", True) == []
    token_files._runs.cache_clear()
