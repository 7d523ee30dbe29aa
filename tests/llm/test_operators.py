"""Small cases for every operator: nulls, empty and long texts, ties, repeats, no rows, odd columns."""

import binascii
import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import compare_oracle
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wattfold.llm import (
    chat, exact_dedup, jaccard, language_id, mixing, neighbours, packing, sharding, token_files, tokenization, warc,
)
from wattfold.llm.components import components
from wattfold.llm.oracles import ORACLES
from wattfold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, rank int"
WORDS = [f"w{i}" for i in range(300)]


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, None, 7, "x", 1) for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(7)
    long = " ".join(rnd.choice(WORDS) for _ in range(30_000))
    base = [rnd.choice(WORDS) for _ in range(80)]
    near = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in (0, 20, 79)]
    texts = [None, "", "  \t\n", "One", "one two", "ONE two", " ".join(base), " ".join(base), *near, long, "É ü 中文 word"]
    rows = [(i, text, "en" if i % 3 else None, ["a", "b", None][i % 3]) for i, text in enumerate(texts)]
    return [*rows, rows[6], (None, "no id", "de", "a")]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return docs_of(spark, odd_rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


def path(name):
    return public_tokenizers.path(name)


def ids_of(name, text):
    tokenizer = Tokenizer.from_file(path(name))
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return binascii.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_tokens_are_the_librarys(name, monkeypatch):
    monkeypatch.setattr(tokenization, "CACHED_PARTS", 40)
    rnd = random.Random(1)
    texts = ["", None, "a  b", " a ", "it's 'x' don't!!", "x\n\ny \n z\tq", "a\x1cb 　c", "é ΑΣ", "<|endoftext|> 12 3"]
    texts += [" ".join(rnd.choice(WORDS) + rnd.choice(["", ",", ".\n"]) for _ in range(20)) for _ in range(20)]
    encoder = tokenization.Encoder(path(name))
    for start in range(0, len(texts), 5):
        block = texts[start : start + 5]
        flat, at = encoder.encode(block, 0)
        assert [list(flat[a:b]) for a, b in zip(at, at[1:], strict=False)] == [ids_of(name, text) for text in block]


def test_language(spark):
    rnd = random.Random(2)
    parts = {"de": ["sch", "ung", "keit"], "es": ["ción", "os", "ado"]}
    rows = []
    for i in range(120):
        lang = ["de", "es"][i % 2]
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(3)) for _ in range(40))
        rows.append((i, text, lang if i < 80 else None, "s"))
    rows += [(200, None, "de", "s"), (201, "12 !!", None, "s"), (202, "", None, "s"), (202, "", None, "s")]
    docs = docs_of(spark, rows)
    model = language_id.fit(spark, docs)
    found = docs.select("doc_id", language_id.identify(spark, model, F.col("text")).alias("f")).select("doc_id", "f.*").collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.lang_pred == ("und" if row.doc_id >= 200 else ["de", "es"][row.doc_id % 2])
        assert 0 <= row.score <= 1
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 120


def test_language_learns_nothing_from_nothing(spark, none):
    model = language_id.fit(spark, none)
    text = spark.createDataFrame([("word",)], "t string")
    assert text.select(language_id.identify(spark, model, F.col("t")).lang_pred).first()[0] == "und"


def test_held_out_accuracy(spark, small):
    found = QUERIES["op1_language_id"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    assert found.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_chat_round_trip(spark):
    nasty = ["</s>", "<\\/s>", "[INST]", "[\\\\/INST]", "<", "[", "<s", "a</s><s>[INST]user[/INST]b</s>", "", None, "$1\\2", "é"]
    turns = [(1, i, ["user", "assistant", "a[/INST]", None][i % 4], text) for i, text in enumerate(nasty)]
    turns += [(2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, None, "user", "n")]
    frame = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn int, role string, text string, mask string")
    rows = {r[0]: r for r in chat.format_chats(frame).select(
        "conv_id", "formatted", chat.parse(F.col("formatted")), chat.learned_text(F.col("formatted"), F.col("mask"))).collect()}
    want = [(role or "", text or "") for _, _, role, text in turns[: len(nasty)]]
    assert [tuple(t) for t in rows[1][2]] == want
    assert rows[1][3] == "".join(text for role, text in want if role == "assistant")
    assert rows[2][3] == "xx" and len(rows[None][2]) == 1
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_control_strings_cut_across_role_and_text(spark):
    rows = []
    for control in ("<s>", "</s>", "[INST]", "[/INST]"):
        for cut in range(len(control) + 1):
            for before, after in (("", ""), ("a", " x"), ("\\", "\\")):
                rows.append((len(rows), 0, before + control[:cut], control[cut:] + after))
                rows.append((len(rows), 0, "assistant" + control[:cut], control[cut:] + after + control))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = chat.format_chats(frame).select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()
    assert {row.conv_id: tuple(row.t[0]) for row in read} == {row[0]: row[2:] for row in rows}
    assert all(len(row.t) == 1 for row in read)


def shingle_classes(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = set() if not w else {tuple(w)} if len(w) < words else {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}
    top = {i: i for i in sets}

    def find(x):
        return x if top[x] == x else find(top[x])

    where = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            where[shingle].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for shingle in s for j in where[shingle] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_similar_documents(spark, odd, odd_rows, none):
    rows = jaccard.similar_documents(spark, odd, 4, 85).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == shingle_classes([r[:2] for r in odd_rows if r[0] is not None], 4, 85)
    assert len(rows) == len(odd_rows) - 1
    assert jaccard.similar_documents(spark, none).count() == 0
    assert jaccard.one_of_each(spark, odd).columns == odd.columns


def test_similar_documents_of_the_table(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for words, percent in ((4, 85), (5, 80)):
        rows = jaccard.similar_documents(spark, spark.read.parquet(f"{small}/documents.parquet"), words, percent).collect()
        assert {r[0]: (r[1], r[2]) for r in rows} == shingle_classes(docs, words, percent)


def test_a_hub_that_is_not_the_first(spark):
    rnd = random.Random(3)
    base = [rnd.choice(WORDS) for _ in range(60)]
    # Copies are similar to the base and not to each other.
    rows = [(i, " ".join([*base[: 2 * i], f"x{i}", *base[2 * i + 1 :]]), None, "s") for i in range(1, 28)]
    rows.insert(13, (99, " ".join(base), None, "s"))
    found = {r[0]: (r[1], r[2]) for r in jaccard.similar_documents(spark, docs_of(spark, rows), 4, 88).collect()}
    assert found == shingle_classes([r[:2] for r in rows], 4, 88)


def test_components_of_a_chain(spark, monkeypatch):
    import wattfold.llm.components as module

    links = module.stored(spark, spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), "chain")
    for most in (500_000, 7):
        monkeypatch.setattr(module, "TASK_LINKS", most)
        assert {tuple(r) for r in components(spark, links).collect()} == {(i, 0) for i in range(1, 41)}


def test_components_of_a_node_with_more_links_than_a_task_takes(spark, monkeypatch):
    import wattfold.llm.components as module

    monkeypatch.setattr(module, "TASK_LINKS", 7)
    pairs = [(50, i) for i in range(60, 100)] + [(3, 99), (1, 2)]
    links = module.stored(spark, spark.createDataFrame(pairs, "a long, b long"), "star")
    found = {tuple(r) for r in components(spark, links).collect()}
    assert found == {(i, 3) for i in [50, *range(60, 100)]} | {(2, 1)}


def test_shards(spark, odd, odd_rows, none):
    rows = sharding.shard_documents(spark, odd, 3).collect()
    assert len(rows) == len(odd_rows)
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    text = {r[0]: r[1] or "" for r in odd_rows}
    together = defaultdict(set)
    for r in rows:
        together[text[r.doc_id]].add(r.shard)
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == binascii.crc32(text[r.doc_id].encode())
    assert all(len(s) == 1 for s in together.values())
    assert sharding.shard_documents(spark, none, 3).count() == 0
    assert sharding.longest_first([(5, "a"), (3, "b"), (3, "c"), (2, "d")], 2) == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]


def test_shards_of_the_table(spark, small):
    loads = Counter()
    for r in QUERIES["op4_sharding"](spark, small).collect():
        loads[r.shard] += r.size
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) < 0.01 * max(loads.values())


def best(items, capacity):
    full = 1 << len(items)
    state = [(99, 0)] * full
    state[0] = (0, capacity)
    for m in range(full):
        for i, size in enumerate(items):
            if not m >> i & 1:
                n, used = state[m]
                state[m | 1 << i] = min(state[m | 1 << i], (n, used + size) if used + size <= capacity else (n + 1, size))
    return state[-1][0]


def test_reduction_keeps_an_optimum_and_best_fit_is_best_fit():
    rnd = random.Random(4)
    for _ in range(60):
        items = [rnd.randint(1, 20) for _ in range(rnd.randint(0, 11))]
        fixed, left = packing.reduce_instance(Counter(items), 20)
        rest = [length for length, n in left.items() for _ in range(n)]
        assert sum(n for n, _ in fixed) + best(rest, 20) == best(items, 20)
        bins = []
        for size in sorted(items, reverse=True):
            fits = [b for b in bins if b[0] >= size]
            fits = [min(fits)] if fits else [[20]]
            bins += [] if any(fits[0] is b for b in bins) else fits
            fits[0][0] -= size
        assert sum(n for n, _ in packing.best_fit(Counter(items), 20)) == len(bins)


def test_packing(spark, odd, odd_rows, none):
    file = "word_bpe_49k.json"
    rows = packing.pack_documents(spark, odd, path(file), 256).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for i, text, *_ in odd_rows:
        ids = ids_of(file, text)
        cuts = range(0, len(ids), 256)
        want += [(-1 if i is None else i, k, a, len(ids[a : a + 256]), crc(ids[a : a + 256])) for k, a in enumerate(cuts)]
    assert got == sorted(want)
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert packing.pack_documents(spark, none, path(file)).count() == 0


def test_blocks():
    rng = np.random.default_rng(5)
    for n in (0, 1, 127, 128, 129, 1000):
        for most in (1, 2, 300, 50_257, 2**32 - 1):
            ids = rng.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
            starts, blocks = token_files.encode_blocks(ids)
            assert (token_files.decode_blocks(starts, np.frombuffer(blocks, np.uint8))[:n] == ids).all()
    counts = np.array([100, 0, 300, 50])
    ids = rng.integers(0, 9999, 450).astype(np.uint32)
    record = token_files.Record(token_files.encode_record(1, 2, [None, 5, 6, 7], counts, ids) + b"\n")
    assert (record.ids(2, 3) == ids[100:400]).all() and record.doc_ids[0] is None


def test_token_files(spark, odd, odd_rows, none, folder):
    file = "byte_bpe_50k.json"
    token_files.write_token_files(spark, odd, f"{folder}/t", path(file))
    rows = sorted(token_files.read_token_files(spark, f"{folder}/t").collect(), key=lambda r: r.start)
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (i, text, *_) in zip(rows, order, strict=True):
        ids = ids_of(file, text)
        assert tuple(row) == (i, start, len(ids), crc(ids))
        start += len(ids)
    token_files.write_token_files(spark, none, f"{folder}/none", path(file))
    assert token_files.read_token_files(spark, f"{folder}/none").count() == 0


def test_mix(spark, odd, odd_rows, none):
    rows = mixing.mix(spark, odd).collect()
    assert len(rows) == len(odd_rows) and sorted(map(str, rows)) == sorted(map(str, mixing.mix(spark, odd).collect()))
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(taken[s] == int(target[s]) for s in target)
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-6
    mixed = mixing.mixed_documents(spark, odd)
    assert mixed.columns == odd.columns
    assert mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(taken.values())
    assert mixing.mix(spark, none).count() == 0 and mixing.mixed_documents(spark, none).count() == 0


def test_dedup(spark, odd, odd_rows, none):
    rows = exact_dedup.exact_duplicates(spark, odd, carry=["n_chars"]).collect()
    groups = defaultdict(list)
    for i, text, *_ in odd_rows:
        groups[text or ""].append(i)
    text = {r[0]: r[1] or "" for r in odd_rows}
    assert len(rows) == len(odd_rows) and sum(r.kept for r in rows) == len(groups)
    for r in rows:
        own = groups[text[r.doc_id]]
        assert r.group_size == len(own) and r.keep_id == (None if own == [None] else max(own))
    clean = exact_dedup.without_duplicates(spark, odd)
    assert clean.columns == odd.columns and clean.count() == len(groups)
    assert exact_dedup.without_duplicates(spark, none).count() == 0
    mixed = docs_of(spark, [(5, "same", None, None), (5, "other", None, None), (9, "same", None, None)])
    left = exact_dedup.without_duplicates(spark, mixed).select("doc_id", "text").collect()
    assert {tuple(r) for r in left} == {(5, "other"), (9, "same")}


def test_warc(spark, folder):
    html = "<head><title>A\n b</title></head><body><p>x &amp; y<br>z</p><a href='/l'>m</a><script>no</script>\r\n\r\n</body>"
    pages = spark.createDataFrame(
        [(1, "http://a/", html, "x"), (2, None, None, "x"), (2, "u", "é" * 9, "x"), (2, "u", "é" * 9, "x")],
        "page_id long, url string, html string, block string",
    )
    source = warc.responses(pages)
    warc.write_warc(source, f"{folder}/w")
    back = warc.read_warc(spark, f"{folder}/w")
    columns = ["warc_type", "record_id", "target_uri", "content_length", "block_digest", "block"]
    assert sorted(map(tuple, back.select(columns).collect()), key=str) == sorted(map(tuple, source.select(columns).collect()), key=str)
    made = warc.derivatives(back).collect()
    assert sorted(map(str, made)) == sorted(map(str, warc.derivatives(source).collect())) and len(made) == 8
    ids = {r.record_id: r for r in source.collect()}
    for r in made:
        assert r.refers_to in ids and r.target_uri == ids[r.refers_to].target_uri
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert f"WARC-Refers-To: {r.refers_to}" in r.headers
    text = next(r.block for r in made if r.warc_type == "conversion" and r.target_uri == "http://a/")
    assert text == "x & y\nz\nm"
    fields = next(r.block for r in made if r.warc_type == "metadata" and r.target_uri == "http://a/")
    assert "title: A b\r\n" in fields and "outlink: /l\r\n" in fields
    assert warc.derivatives(source.limit(0)).count() == 0


def brute_neighbours(rows, k):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in good:
        if q % 50 == 0:
            near = [(-float((v * w).sum() / np.sqrt((v * v).sum()) / np.sqrt((w * w).sum())), i)
                    for i, w in good if i != q and len(w) == len(v)]
            out[q] = sorted((round(s, 9), i) for s, i in near)[:k]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    rows += [(401, None), (402, [0.0] * 8), (403, [float("nan")] * 8), (404, [None] * 8), (None, [1.0] * 8), (450, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    found = neighbours.nearest(spark, frame, neighbours.every_nth(frame), 5, 1.0, shard_rows=200, block_queries=4).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((round(-r.score, 9), r.vec_id))
    assert dict(got) == {q: n for q, n in brute_neighbours(rows, 5).items() if n}
    empty = frame.limit(0)
    assert neighbours.nearest(spark, empty, empty, 5).count() == 0


def test_recall(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    truth = brute_neighbours([(r.vec_id, r.embedding) for r in table.collect()], 5)
    found = {(r.query_id, r.vec_id) for r in QUERIES["op10_nearest_neighbours"](spark, small).collect()}
    want = {(q, i) for q, near in truth.items() for _, i in near}
    assert len(found & want) >= 0.9 * len(want)


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns, name
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and json.dumps(rows[0].asDict())


def test_pipeline_of_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
        docs.collect()


@pytest.fixture(scope="module")
def duck(small):
    return compare_oracle.duck(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, small, name):
    assert compare_oracle.difference(spark, duck, small, name) is None
