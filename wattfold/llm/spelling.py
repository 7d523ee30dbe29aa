"""Spelling variants: words one edit apart, found with an index of variable-length grams.

Grams are as long as they must be to be rare: a gram that more words have than the dictionary allows
is extended by the next letter. The dictionary holds the frequent grams, those that are extended.
A word, with a mark before and after it, has one gram at each place. An edit reaches only the grams
that cover its place, so every word has for each place the grams that an edit there leaves alone;
two words one edit apart have the same ones, in the same order. The lists of these grams' words are
merged for each place as a hash of all of them, and what meets under a hash is verified letter by
letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import mix64, stored

# Letters of a run: A to Z, a to z and U+00C0 to U+00FF, each one byte in Latin-1.
LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
# Least and greatest letters of a gram, marks included.
SHORTEST, LONGEST = 2, 4
# Grams of one length that the dictionary holds at most: a gram is frequent if it has more than this
# share of all places.
FREQUENT = 4_096
# Letters up to which a place's remainder is compared itself; longer ones are compared by 128 bits.
WHOLE = 64
DAMAGED_ONE_IN = 31
# Letters that one step lays out.
BLOCK_LETTERS = 1 << 18
# Bytes that stand for the marks; no letter has them.
_BEFORE, _AFTER = 1, 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def damaged_runs(docs: DataFrame) -> DataFrame:
    """``word``: every run of letters, A to Z in lower case, of which about one in 31 loses a letter.

    A null text has no runs, a null id counts as empty. Shorter runs than a word needs are left out.
    """
    pattern = rf"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("run"),
    )
    runs = runs.withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.select(F.when(F.col("h") % DAMAGED_ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(spark: SparkSession, words: DataFrame) -> DataFrame:
    """``id, word, n``: different words that are long and frequent enough; a smaller id is a more
    frequent word or, of equal counts, a smaller one in code-point order."""
    counts = words.where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    counts = counts.where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "word")
    return stored(spark, counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and letters (a row per word, marks included) of the batch's words of equal length."""
    ids = batch.column("id").to_numpy()
    words = [word.encode("latin-1") for word in batch.column("word").to_pylist()]
    sizes = np.array([len(word) for word in words], np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, BLOCK_LETTERS // size)
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            letters = np.empty((len(part), size + 2), np.uint8)
            letters[:, 0], letters[:, -1] = _BEFORE, _AFTER
            letters[:, 1:-1] = np.frombuffer(b"".join([words[row] for row in part]), np.uint8).reshape(-1, size)
            yield ids[part], letters


def _packed(letters: np.ndarray, length: int) -> np.ndarray:
    """The gram of ``length`` letters that begins at each place, its letters as the bytes of a number."""
    places = letters.shape[1] - length + 1
    grams = np.zeros((len(letters), max(places, 0)), np.uint32)
    for at in range(length):
        grams = (grams << np.uint32(8)) | letters[:, at : at + grams.shape[1]]
    return grams


def gram_dictionary(words: DataFrame) -> dict[int, np.ndarray]:
    """The frequent grams of each length below the longest, sorted: ``FREQUENT`` of a length at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _blocks(batch):
                for length in range(SHORTEST, LONGEST):
                    grams, counts = np.unique(_packed(letters, length), return_counts=True)
                    lengths = np.full(len(grams), length, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lengths), pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                        ["length", "gram", "places"],
                    )

    found = words.mapInArrow(counted, "length int, gram long, places long")
    counts = found.groupBy("length", "gram").agg(F.sum("places").alias("places"))
    totals = counts.groupBy("length").agg(F.sum("places").alias("total"))
    frequent = counts.join(totals, "length").where(F.col("places") * FREQUENT > F.col("total"))
    rows = frequent.select("length", "gram").collect()
    return {
        length: np.array(sorted(row["gram"] for row in rows if row["length"] == length), np.uint32)
        for length in range(SHORTEST, LONGEST)
    }


def decompose(letters: np.ndarray, dictionary: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The gram at each place but the last mark's, and its length.

    A gram ends where it stops being frequent, so it follows from its own letters alone.
    """
    places = letters.shape[1] - 1
    grams = _packed(letters, SHORTEST)
    lengths = np.full(grams.shape, SHORTEST, np.int64)
    for length in range(SHORTEST, LONGEST):
        longer = _packed(letters, length + 1)
        room = longer.shape[1]
        grow = (lengths[:, :room] == length) & np.isin(grams[:, :room], dictionary[length])
        grams[:, :room] = np.where(grow, longer, grams[:, :room])
        lengths[:, :room] += grow
    assert grams.shape[1] == places
    return grams, lengths


def _hashed(values: np.ndarray, places: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(mix64(values.astype(np.uint64) + np.uint64(seed << 40)) + places.astype(np.uint64))


def _sums(values: np.ndarray, lengths: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``left[e]``: hash of all that ends before place ``e``; ``right[e]``: of all that begins at ``e`` or after."""
    places = np.arange(values.shape[1])
    ends = np.zeros((len(values), width + LONGEST), np.uint64)
    with np.errstate(over="ignore"):
        from_start = _hashed(values, places[None, :], seed)
        for length in np.unique(lengths).tolist():
            # What ends at p + length - 1 counts from p + length on.
            ends[:, length : length + values.shape[1]] += np.where(lengths == length, from_start, np.uint64(0))
        left = np.cumsum(ends, axis=1, dtype=np.uint64)
        from_end = _hashed(values, width - places[None, :], seed + 1)
        right = np.zeros((len(values), width + 1), np.uint64)
        right[:, : values.shape[1]] = np.cumsum(from_end[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    return left, right


def affected(lengths: np.ndarray, width: int) -> np.ndarray:
    """How many grams of each word cover each place: what one edit there can reach."""
    covers = np.zeros((len(lengths), width + 1), np.int64)
    for length in np.unique(lengths).tolist():
        has = (lengths == length).astype(np.int64)
        covers[:, : lengths.shape[1]] += has
        covers[:, length : length + lengths.shape[1]] -= has[:, : width + 1 - length]
    return np.cumsum(covers, axis=1)[:, :width]


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a byte matrix as binary values."""
    count, width = rows.shape
    offsets = np.arange(count + 1, dtype=np.int32) * np.int32(width)
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _merged(letters: np.ndarray, dictionary: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Per place: the merged list's key, what is left of the word, and the word's part in the list.

    Parts: 1 and 2 are words with a letter at the place (2 if the letter repeats the one before it), 0 is
    a word whose gap there may take one. A letter's key names the word's size, a gap's the size it
    would have. Only the first of a run of equal letters (1) stands for the run's deletion, so each pair
    meets once.
    """
    count, width = letters.shape
    size = width - 2
    grams, lengths = decompose(letters, dictionary)
    left, right = _sums(grams, lengths, width, 1)
    # The grams that an edit leaves alone, told by their number too: all of the word's but the affected.
    spared = lengths.shape[1] - affected(lengths, width)
    long = size > WHOLE
    if long:
        ones = np.ones(letters.shape, np.int64)
        checks = [_sums(letters, ones, width, seed) for seed in (3, 5)]

    def rest(before: int, after: int) -> pa.Array:
        """All letters before the one place and from the other on."""
        if long:
            with np.errstate(over="ignore"):
                halves = [a[:, before] + b[:, after] for a, b in checks]
            return _binary(np.stack(halves, 1).view(np.uint8))
        return _binary(np.concatenate([letters[:, 1:before], letters[:, after:-1]], axis=1))

    with np.errstate(over="ignore"):
        for place in range(1, size + 1):
            tag = np.uint64(size << 20 | place)
            key = mix64(left[:, place] + right[:, place + 1] + spared[:, place].astype(np.uint64) + mix64(np.array([tag])))
            again = letters[:, place] == letters[:, place - 1]
            yield key, rest(place, place + 1), np.where(again, 2, 1)
        # A gap before ``place`` leaves alone what ends before it or begins there; grams across it are reached.
        for place in range(1, size + 2):
            across = np.zeros(count, np.int64)
            for start in range(max(0, place - LONGEST + 1), place):
                across += start + lengths[:, start] > place
            tag = np.uint64((size + 1) << 20 | place)
            kept = (lengths.shape[1] - across).astype(np.uint64)
            key = mix64(left[:, place] + right[:, place] + kept + mix64(np.array([tag])))
            yield key, rest(place, place), np.zeros(count, np.int64)


def _lists(words: DataFrame, dictionary: dict[int, np.ndarray]) -> DataFrame:
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, letters in _blocks(batch):
                for key, rest, part in _merged(letters, dictionary):
                    columns = [pa.array(key.view(np.int64)), rest, pa.array(ids), pa.array(part.astype(np.int8))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "rest", "id", "part"])

    return words.select("id", "word").mapInArrow(keyed, "key long, rest binary, id long, part byte")


def _near_of(keys: np.ndarray, rests: np.ndarray, ids: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    """Verified members of whole lists: for each member its near words' count there and the least id."""
    none = np.iinfo(np.int64).max
    order = np.lexsort((ids, rests, keys))
    keys, rests, ids, parts = keys[order], rests[order], ids[order], parts[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (rests[1:] != rests[:-1])])
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    letter = parts > 0

    def least(values: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(values, starts)

    gap = least(np.where(parts == 0, ids, none))[group]
    count = np.add.reduceat(letter.astype(np.int64), starts)[group]
    runs = np.add.reduceat((parts == 1).astype(np.int64), starts)[group]
    first = least(np.where(letter, ids, none))[group]
    second = least(np.where(letter & (ids != first), ids, none))[group]
    first_run = least(np.where(parts == 1, ids, none))[group]
    other = np.where(ids == first, second, first)
    near = np.where(letter, count - 1 + ((parts == 1) & (gap != none)), runs)
    best = np.where(letter, np.where(parts == 1, np.minimum(other, gap), other), first_run)
    use = near > 0
    return pa.RecordBatch.from_arrays([pa.array(x[use]) for x in (ids, near, best)], ["id", "near", "best"])


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """``id, n_near, best``: for each word with near ones how many there are and the least id of them.

    A merged list that is verified holds words that agree in all but one given letter, so it has no more
    of them than there are letters, however many words there are: no list is long, none is cut.
    """
    dictionary = gram_dictionary(words)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = table.column("key").to_numpy()
            if not len(keys):
                continue
            # The last list may go on in the next batch.
            whole = int(np.flatnonzero(keys == keys[-1])[0])
            yield _of(table.slice(0, whole))
            held = table.slice(whole).combine_chunks()
        if held is not None:
            yield _of(held)

    def _of(table: pa.Table) -> pa.RecordBatch:
        keys = table.column("key").to_numpy()
        alone = np.ones(len(keys), bool)
        if len(keys) > 1:
            same = keys[1:] == keys[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
        table = table.filter(pa.array(~alone))
        if not table.num_rows:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["id", "near", "best"])
        rests = table.column("rest").combine_chunks().dictionary_encode()
        rests = (rests.combine_chunks() if isinstance(rests, pa.ChunkedArray) else rests).indices.to_numpy()
        columns = [table.column(name).to_numpy() for name in ("key", "id", "part")]
        return _near_of(columns[0], rests, columns[1], columns[2])

    lists = _lists(words, dictionary).repartition("key").sortWithinPartitions("key")
    pairs = lists.mapInArrow(met, "id long, near long, best long")
    return pairs.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``id, root``: where forms lead to. Each form has ten times its word's count, so chains are short."""
    links = stored(spark, forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = links.join(ahead, "root", "left")
        moved = step.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(spark, moved, "spelling-roots")
        links = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return links


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for a vocabulary ``id, word, n`` as ``vocabulary`` makes it.

    Near words differ by one inserted, deleted or replaced letter. A word's form is its near word of
    largest count (ties: smallest in code-point order) if that has ``ratio`` times the word's count;
    its root is where forms lead to, itself if it has no form. An empty vocabulary gives no rows. Words
    are letters up to U+00FF; other columns are not looked at.
    """
    near = stored(spark, near_words(spark, words), "spelling-near")
    counts = words.select(F.col("id").alias("best"), F.col("n").alias("best_n"))
    found = words.select("id", "n").join(near, "id").join(counts, "best")
    forms = found.where(F.col("best_n") >= F.col("n") * ratio).select("id", F.col("best").alias("form"), "best_n")
    forms = stored(spark, forms, "spelling-forms")
    roots = _roots(spark, forms)
    named = forms.join(roots, "id")
    for name in ("form", "root"):
        spelt = words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
        named = named.join(spelt, name)
    named = named.select("id", "form_word", "root_word", F.col("best_n").alias("form_n"))
    rows = words.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
    return rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("form_word").alias("form"), "form_n",
        F.coalesce("root_word", "word").alias("root"),
    )


def spelling_variants(spark: SparkSession, docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Variants among the words of all documents' damaged runs.

    Nulls and empty texts have no words, repeated rows count again, and columns but ``doc_id`` and ``text``
    are not looked at. A run of any length is a word; its places are that many rows.
    """
    return variants(spark, vocabulary(spark, damaged_runs(docs)), ratio)
