"""Cases in which an operator once lost rows or held too much: null and repeated ids, hot keys, rare languages."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattfold.llm import common, exact_dedup, jaccard, language_id, mixing, packing, tokenization
from wattfold.llm.shingles import bits_apart, folded, most_apart, signatures

SCHEMA = "doc_id long, text string, lang string, source string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, None, "s")[:4] for row in rows], SCHEMA)


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(None, "a"), (None, "a"), (None, "b")], [(None, "a"), (None, "b")]),
        ([(None, "a"), (5, "a"), (None, "b"), (None, "c")], [(5, "a"), (None, "b"), (None, "c")]),
        ([(None, "a"), (None, "a"), (4, "b"), (4, "c"), (5, "c")], [(None, "a"), (4, "b"), (5, "c")]),
    ],
)
def test_null_ids_keep_their_own_texts(spark, rows, want):
    clean = exact_dedup.without_duplicates(spark, docs_of(spark, rows))
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(want)


def test_carried_values_are_each_rows_own(spark):
    rows = [(1, "a", 10, "x"), (1, "a", 20, "y"), (1, "a", 20, "y"), (1, "a", None, None), (2, "b", 5, "z"), (None, "c", 1, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, __part string")
    found = exact_dedup.exact_duplicates(spark, docs, carry=["n", "__part"])
    got = Counter((r.doc_id, r.n, r["__part"], r.group_size, r.kept) for r in found.collect())
    assert got == Counter([(1, 10, "x", 4, False), (1, 20, "y", 4, True), (1, 20, "y", 4, False), (1, None, None, 4, False),
                           (2, 5, "z", 1, True), (None, 1, "n", 1, True)])


@pytest.mark.parametrize("rare", [1, 3])
def test_rare_languages_are_learned_beside_a_large_one(spark, rare):
    rnd = random.Random(11)
    latin, greek = ["tion", "ing", "ter", "and", "ous"], ["ος", "ται", "και", "ων", "μεν", "λογ", "φα", "ρι"]

    def text(parts, n):
        return " ".join("".join(rnd.choice(parts) for _ in range(3)) for _ in range(n))

    rows = [(i, text(latin, 60), "en") for i in range(100)] + [(1000 + i, text(greek, 12), "el") for i in range(rare)]
    docs = docs_of(spark, rows)
    model = language_id.fit(spark, docs)
    found = docs.select("lang", language_id.identify(spark, model, F.col("text")).alias("f")).select("lang", "f.*").collect()
    assert all(row.lang_pred == row.lang for row in found)
    assert corpus_pipeline.identify_language(spark, docs, "").count() == len(rows)


def test_a_hot_keys_pairs_are_made_once_in_tiles_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 64, raising=False)
    n, sketch = 600, bytes(64)
    rows = [(1, i, 40 + i % 3, i, n, sketch) for i in range(n)]
    rows += [(2, 1000 + i, 40, i // 2, 4, sketch) for i in range(4)]
    members = spark.createDataFrame(rows, "key long, c long, n long, label long, size long, sketch binary")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        found = []
        for first, last in ((0, 64), (64, 4160)):
            pairs = jaccard._later_pairs(members, first, last, 80)
            found += [(min(r[:2]), max(r[:2]), r[2]) for r in pairs.select("a", "b", F.spark_partition_id()).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    tasks = Counter(r[2] for r in found)
    assert len(tasks) > 8 and max(tasks.values()) < n * n / 4
    ends = Counter((a, b) for a, b, _ in found)
    want = {(i, j) for i in range(n) for j in range(i)} | {(1000 + i, 1000 + j) for i in range(4) for j in range(i) if i // 2 != j // 2}
    assert set(ends.values()) == {1} and len(ends) == len(want)


def test_a_hot_key_meets_its_first_member(spark, monkeypatch):
    rows = [(1, 9, i % 300) for i in range(600)] + [(2, 5, 7), (2, 5, 7), (3, 5, 8), (3, 4, 9), (4, 1, 1)]
    keys = spark.createDataFrame(rows, "key long, n int, c long").repartition(4)
    want = sorted((1, 0, 9, c, 9) for c in range(1, 300)) + [(3, 9, 4, 8, 5)]
    for hot in (100_000, 0):
        monkeypatch.setattr(jaccard, "HOT", hot)
        assert sorted(map(tuple, jaccard._meetings(spark, keys, keys).collect())) == want


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_refuse_unlike_sets_of_any_size(percent):
    rnd = np.random.default_rng(5)
    for n in (100, 900, 2_000, 5_000, 40_000):
        sets = [rnd.integers(0, 1 << 63, m, dtype=np.uint64) for m in (n, n, n * 9 // 10)]
        sets.append(np.concatenate([sets[0][: n - n // 20], rnd.integers(0, 1 << 63, n // 20, dtype=np.uint64)]))
        owners = np.repeat(np.arange(4), [len(x) for x in sets])
        sizes, _, _, sketch = signatures(owners, np.concatenate(sets), 4, percent)
        width = min(len(x.as_py()) for x in sketch)
        rows = folded(sketch, width)
        i, j = np.array([0, 0, 1, 0]), np.array([1, 2, 2, 3])
        near = bits_apart(rows, rows, i, j) <= most_apart(sizes[i] + sizes[j], percent)
        assert near.tolist() == [False, False, False, True]


def test_long_texts_with_and_without_links(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(3_000)]
    bases = [[rnd.choice(words) for _ in range(5_000)] for _ in range(4)]
    passage = [rnd.choice(words) for _ in range(600)]
    texts = [" ".join(base + passage) for base in bases]
    for base, cut in zip(bases, (5, 40, 700, 1_500), strict=True):
        changed = base[: len(base) - cut] + [rnd.choice(words) for _ in range(cut)]
        texts.append(" ".join(changed + passage))
    found = jaccard.similar_documents(spark, docs_of(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0, 5: 1, 6: 6, 7: 7}


def test_unlike_sets_of_a_hot_key_in_small_tiles(spark, monkeypatch):
    for name, value in (("TILE", 8), ("HOT", 0), ("GROWTH", 3), ("SLICE", 5)):
        monkeypatch.setattr(jaccard, name, value)
    rnd = random.Random(3)
    common = [f"c{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        words = common[: rnd.randint(38, 60)] + [f"x{rnd.randint(0, 30)}" for _ in range(rnd.randint(0, 8))]
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 2]) for k in range(len(w) - 1)} for w in (t.split() for t in texts)]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    found = jaccard.similar_documents(spark, docs_of(spark, list(enumerate(texts))), 2, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(label))
    assert 1 < len(set(label)) < len(label)


@pytest.mark.parametrize("chunk_rows", [50_000, 7])
def test_the_mix_itself_is_what_the_shares_say(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(mixing.running_sum, "__defaults__", (chunk_rows,))
    rnd = random.Random(9)
    rows = []
    for i in range(240):
        text = None if i % 17 == 0 else " ".join(f"w{rnd.randint(0, 99)}" for _ in range(rnd.randint(0, 40)))
        rows.append((i if i % 5 else None, text, None, ["a", "b", "c", None][i * i % 4]))
    # A source of one text under one id, which the cut falls into.
    rows += [(7, "six words that are all alike", None, "same")] * 60 + [(None, "no id", None, "same")] * 30
    docs = spark.createDataFrame(rows, SCHEMA)
    size = mixing.word_count(F.col("text"))
    want = Counter()
    for r in mixing.mix(spark, docs).collect():
        want[(r.doc_id, r.source)] += r.taken
    got, parts = Counter(), Counter()
    whole = {(i, text) for i, text, _, _ in rows}
    for r in mixing.mixed_documents(spark, docs).select("*", size.alias("size")).collect():
        got[(r.doc_id, r.source)] += r["size"]
        parts[r.source] += (r.doc_id, r.text) not in whole
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n}
    assert all(n <= 1 for n in parts.values())


def test_a_round_pairs_each_member_with_few_as_what_it_links_is_left_to_no_other(spark):
    n, sketch = 300, bytes(64)
    members = spark.createDataFrame(
        [(1, i, 40, i, n, sketch) for i in range(n)], "key long, c long, n long, label long, size long, sketch binary"
    )
    assert n - 1 <= jaccard._later_pairs(members, 0, jaccard.next_place(0), 80).count() <= 12 * n
    # Rounds adjoin and grow, so that a group that links nowhere is done after a few of them.
    places = [0]
    while places[-1] < 100_000:
        places.append(jaccard.next_place(places[-1]))
    assert all(a < b for a, b in zip(places, places[1:])) and len(places) < 12


LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_whole_texts_go_to_workers_by_the_megabyte(spark):
    """The largest batch follows its bytes, not its rows, while an operator works; the session keeps its limit."""
    docs = spark.range(3_000, numPartitions=1).select("id", F.repeat(F.lit("w "), 2_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    @common.small_batches
    def work(spark):
        return common.stored(spark, docs.mapInArrow(sizes, "n long, bytes long"), "test-batches")

    before = spark.conf.get(LIMIT)
    n, most = work(spark).agg(F.sum("n"), F.max("bytes")).first()
    assert n == 3_000 and most <= 1.5 * common.BATCH_BYTES
    assert spark.conf.get(LIMIT) == before
    try:
        spark.conf.set(LIMIT, 1_000)
        assert work(spark).agg(F.max("bytes")).first()[0] < 20_000
        assert spark.conf.get(LIMIT) == "1000"
    finally:
        spark.conf.set(LIMIT, before)


def test_stages_that_hold_texts_limit_their_batches(spark, monkeypatch):
    seen = {}
    for module in (jaccard, packing):
        def kept(session, frame, label, put=module.stored):
            seen.setdefault(label, set()).add(spark.conf.get(LIMIT))
            return put(session, frame, label)

        monkeypatch.setattr(module, "stored", kept)
    docs = docs_of(spark, [(i, f"a b c d e f g h {i % 3}", "en") for i in range(9)])
    before = spark.conf.get(LIMIT)
    try:
        jaccard.one_of_each(spark, docs).collect()
        packing.pack_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json")).collect()
        assert {"jaccard-sets", "jaccard-meetings", "pack-pieces"} <= set(seen)
        assert set().union(*seen.values()) == {str(common.BATCH_BYTES)}
        assert spark.conf.get(LIMIT) == before
        corpus_pipeline.identify_language(spark, docs, "")
        assert spark.conf.get(LIMIT) == str(common.BATCH_BYTES)
    finally:
        spark.conf.set(LIMIT, before)


def test_what_a_worker_keeps_can_be_dropped_and_made_again():
    file = public_tokenizers.path("word_bpe_49k.json")
    ids = tokenization.encoder(file).encode(["a few words"])[0].tolist()
    common.drop_kept()
    assert not tokenization._ENCODERS
    assert tokenization.encoder(file).encode(["a few words"])[0].tolist() == ids


def test_an_encoder_that_keeps_few_words_gives_the_same_ids(spark):
    file = public_tokenizers.path("word_bpe_49k.json")
    docs = docs_of(spark, [(i, f"word{i} word{i % 7} and the rest {i * 31}") for i in range(200)])
    plain = packing.token_pieces(docs, file)
    lean = packing.token_pieces(docs, file, block_bytes=1_000, cached_parts=40)
    assert sorted(map(tuple, lean.collect())) == sorted(map(tuple, plain.collect()))
