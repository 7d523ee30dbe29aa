"""Turn repair, spelling variants and language-model scores against plain versions, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import compare_oracle
import numpy as np
import pyarrow as pa
import pytest

from wattfold.llm import context_mixing, spelling, turn_repair
from wattfold.llm.queries import QUERIES

ROLES = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)


def cheapest(turns, faults):
    """Forward search: for each state the least (cost, edits) and the turns they give."""
    best = {0: (0, "", ())}

    def put(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def insert(into):
        for _ in range(4):
            for state in list(into):
                cost, audit, out = into[state]
                put(into, NEXT[state], (cost + 5, audit + "I", (*out, (ROLES[state], ""))))
        return into

    best = insert(best)
    for (_, role, text), fault in zip(turns, faults, strict=True):
        after = {}
        for state, (cost, audit, out) in best.items():
            put(after, state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if (role[:1], state) in KEPT:
                put(after, KEPT[role[:1], state], (cost + more, audit + "K", (*out, (role, text))))
            put(after, NEXT[state], (cost + more + 1, audit + "R", (*out, (ROLES[state], text))))
        best = insert(after)
    return min(best[state] for state in (0, 3) if state in best)


def repaired(rows):
    convs = defaultdict(list)
    for conv, *turn in damage(rows):
        convs[conv].append(tuple(turn))
    for conv in {row[0] for row in rows}:
        turns = sorted(convs[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            written = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not written else "duplicate" if (role, text) in seen else
                          "truncated" if written[-1] not in ".!?" else "")
            seen.add((role, text))
        numbers = [turn for turn, _, _ in turns if turn is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, out = cheapest(turns, faults)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
        yield (conv, gaps, *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def conversations(spark, folder, rows):
    schema = "conv_id long, turn long, role string, text string, pos string, digest int"
    spark.createDataFrame([(*row, "x", 1) for row in rows], schema).write.parquet(f"{folder}/conversations.parquet")
    return [tuple(row) for row in QUERIES["op11_structure_repair"](spark, folder).select(*REPORT).collect()]


@pytest.mark.parametrize("block", [5, 4096])
def test_repairs_are_the_cheapest_and_least(spark, folder, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    monkeypatch.setattr(turn_repair, "SPAN", 2)
    rnd, rows = random.Random(5), []
    for conv in [None, *range(40)]:
        for turn in range(150 if conv and conv % 10 == 7 else rnd.choice([0, 1, 2, 5, 9])):
            odd = rnd.random() < 0.3
            role = rnd.choice(["user", "assistant", "system", "User", None, ""]) if odd else ["user", "assistant"][turn % 2]
            text = rnd.choice(["a.", "b", "c?", "d!  ", "", " \n", None, f"w{turn}.", f"w{turn}.", f"v{turn}", "x\ny. \n "])
            # Conversations whose chunks never make cost vectors alike: all copies, and all truncated.
            text = {17: "z", 27: f"z{turn}"}.get(conv, text)
            number = None if rnd.random() < 0.03 else turn if rnd.random() < 0.95 else turn - 1
            rows += [(conv, number, role, text)] * rnd.choice([1, 1, 1, 2])
    got = conversations(spark, folder, rows)
    assert Counter(got) == Counter(repaired(rows))


def test_repair_of_nothing_and_of_long_texts(spark, folder):
    assert conversations(spark, f"{folder}/none", []) == []
    # A conversation of which every row is dropped has a row of its own.
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "a."), (5001, 1, "user", "x" * 300_000 + "."), (5001, 2, "assistant", "y " * 100_000)]
    got = conversations(spark, folder, rows)
    assert Counter(got) == Counter(repaired(rows))
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_repaired_turns_are_given_with_their_edits(spark):
    turns = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c"), (1, 3, "assistant", "d.")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    report, made = turn_repair.repair(spark, frame)
    row = report.first()
    assert (row.cost, row.audit, row.truncated, row.illegal) == (2 + 2, "DKDK", 1, 2)
    assert [(r.edit, r.role, r.text) for r in made.orderBy("pos", "beside").collect()] == [("K", "user", "b."), ("K", "assistant", "d.")]


def test_chunks_rerun_only_until_vectors_are_alike():
    codes = bytes([1, 2] * 200)
    whole, cost = turn_repair._backward(codes, turn_repair.END)
    other = (0, 0, 0, 0)
    speculative, guess = turn_repair._backward(codes, other)
    came, change = turn_repair._rerun(codes, other, turn_repair.END)
    assert (speculative if came is None else came, guess + change) == (whole, cost)
    assert came is None  # the start is reached only by vectors that became alike on the way


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    n = {word: c for word, c in counts.items() if len(word) >= 7 and c >= 2}

    def is_near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {word: [other for other in n if is_near(word, other)] for word in n}
    best = {word: min(others, key=lambda o: (-n[o], o)) for word, others in near.items() if others}
    form = {word: other for word, other in best.items() if n[other] >= 10 * n[word]}
    for word in n:
        root = word
        while root in form:
            root = form[root]
        yield word, n[word], len(near[word]), form.get(word), n.get(form.get(word)), root


def variants(spark, rows):
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, id int, word string")
    found = spelling.spelling_variants(spark, docs)
    return Counter(tuple(row) for row in found.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("frequent", [2, 4096])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)  # hardly any gram is extended, or nearly all are
    rnd = random.Random(3)
    base = ["abcdefg", "aaaaaaa", "éèaaaabb", "x" * 80, "TheTheThe", "ingtioner"]

    def changed(word):
        at, kind, letter = rnd.randrange(len(word)), rnd.random(), rnd.choice("abxé÷")
        return word[:at] + ("" if kind < 0.3 else letter) + word[at + (kind < 0.6 and 0 or 1) * (kind >= 0.3) :]

    rows = []
    for doc in range(120):
        words = []
        for _ in range(30):
            word = rnd.choice(base)
            while rnd.random() < 0.4 and len(word) > 6:
                word = changed(word)
            words.append(word)
        rows.append((doc, " ".join(words)))
    rows += [(None, None), (None, "abcdefg_" * 500), (3, ""), (3, "12 中文 ΑΒΓΔΕΖΗΘ"), *rows[:2]]
    assert variants(spark, rows) == Counter(plain_variants(rows))


def test_variants_of_nothing_and_of_very_long_words(spark):
    assert variants(spark, []) == Counter()
    assert variants(spark, [(1, None), (2, "short only")]) == Counter()
    long = "ab" * 1500
    rows = [(n, f"{long} {long[:700]}{long[701:]} {long[:-1]}x") for n in range(40)]
    assert variants(spark, rows) == Counter(plain_variants(rows))


def test_affected_grams_bound_what_an_edit_reaches():
    letters = np.frombuffer(b"\x01abcabca\x02", np.uint8)[None, :]
    grams, lengths = spelling.decompose(letters, {2: spelling._packed(letters, 2)[0, 1:2], 3: np.zeros(0, np.uint32)})
    assert lengths.tolist() == [[2, 3, 2, 2, 3, 2, 2, 2]]
    assert spelling.affected(lengths, letters.shape[1]).tolist() == [[1, 2, 2, 3, 2, 2, 3, 2, 1]]


DOC = "doc_id long, text string, held_out boolean, token int, kind string"


def scored(spark, rows):
    docs = spark.createDataFrame([(i, text, held_out, 1, "x") for i, text, held_out in rows], DOC)
    found = context_mixing.score(spark, docs)
    assert found.columns[:4] == ["doc_id", "held_out", "token", "kind"]
    return found.collect()


def texts(count):
    rnd = random.Random(4)
    parts = {0: ["sch", "ung", "keit", "ver", "ein"], 1: ["ción", "os", "ado", "la", "que"]}
    frequent = {0: ["der", "die", "und"], 1: ["el", "la", "de"]}
    for n in range(count):
        own, often = parts[n % 2], frequent[n % 2]
        words = [rnd.choice(often) if rnd.random() < 0.4 else "".join(rnd.choices(own, k=rnd.randint(2, 4))) for _ in range(120)]
        yield n, " ".join(words), n % 10 == 9


def test_counts_and_base_scores_are_those_of_a_plain_count(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "HOT", 50)  # most words are joined, a few are told to all tasks
    monkeypatch.setattr(context_mixing, "COUNTED", 40)
    rows = [*texts(60), (100, None, False), (101, "", True), (102, "A a\x1cb\ta", False), (102, "A a\x1cb\ta", False), (None, "new words", True)]
    counts = Counter()
    for _, text, held_out in rows:
        if not held_out:
            counts.update([*(text or "").lower().encode().split(), b"\n"])
    total, different = sum(counts.values()), len(counts)
    got = scored(spark, rows)
    assert len(got) == len(rows)
    by_id = defaultdict(list)
    for row in got:
        by_id[row.doc_id].append(row)
    for doc_id, text, _ in rows:
        row, words = by_id[doc_id].pop(), [*(text or "").lower().encode().split(), b"\n"]
        base = sum(math.log10((counts[word] + 0.1) / (total + 0.1 * (different + 1))) for word in words)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(counts[word] > 0 for word in words), total)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert math.isfinite(row.score) and row.score < 0 and row.bits_per_byte > 0


def test_held_out_texts_are_told_better_than_by_word_counts(spark):
    got = [row for row in scored(spark, list(texts(300))) if row.held_out]
    assert len(got) == 30
    assert sum(row.score for row in got) > sum(row.base_score for row in got)
    again = [row for row in scored(spark, list(texts(300))) if row.held_out]
    assert np.allclose(sorted(row.score for row in got), sorted(row.score for row in again), rtol=1e-9)


def test_scores_without_training_texts_and_without_texts(spark):
    assert scored(spark, []) == []
    got = scored(spark, [(1, "some words", True), (2, None, True)])
    assert [row.train_tokens for row in got] == [0, 0] and all(row.score < 0 for row in got)


def test_bits_of_words_make_a_distribution():
    words = [b"abc", b"abd", b"b", context_mixing.END, b"\xc3\xa9t\xc3\xa9", b"x" * 9000]
    trie = context_mixing.lay_out(words, [0] * len(words))
    counts = np.zeros(-(-context_mixing._SLOTS // context_mixing.PAGE) * context_mixing.PAGE, np.uint32)
    rng = np.random.default_rng(1)
    counts[:] = rng.integers(0, 50, len(counts)) << 16 | rng.integers(0, 50, len(counts))
    model = context_mixing._untrained(counts)
    scores = context_mixing.token_scores(model, words, [0] * len(words))
    alone = [context_mixing.token_scores(model, [word], [0])[0] for word in words]
    assert np.allclose(scores, alone)  # shared beginnings change nothing
    # Over all 256 values of a byte after one beginning, probabilities add up to one.
    total = 0.0
    for value in range(256):
        if value in (0x20, 0x0A):
            continue
        word = b"ab" + bytes([value])
        trie = context_mixing.lay_out([word], [0])
        steps = next(context_mixing._steps(trie, np.array([2])))
        one = context_mixing.bit_probabilities(model, steps[3], steps[1], steps[2])
        total += float(np.prod(np.where(steps[1] == 1, one, 1 - one)))
    trie = context_mixing.lay_out([b"ab"], [0])
    steps = next(context_mixing._steps(trie, np.array([2])))
    one = context_mixing.bit_probabilities(model, steps[3], steps[1], steps[2])
    total += float(np.prod(np.where(steps[1] == 1, one, 1 - one)))
    assert 0.99 < total <= 1.0 + 1e-9


def test_words_through_a_byte_are_added_up():
    words, counts = [b"to", b"tea", b"ten", b"a"], np.array([5.0, 2.0, 1.0, 7.0])
    trie = context_mixing.lay_out(words, [0] * 4)
    sums = context_mixing._through(trie, counts)
    assert sorted(zip(bytes(trie.letters).decode(), sums.tolist(), strict=True)) == sorted(
        [("t", 8.0), ("o", 5.0), (" ", 5.0), ("e", 3.0), ("a", 2.0), (" ", 2.0), ("n", 1.0), (" ", 1.0), ("a", 7.0), (" ", 7.0)]
    )


@pytest.mark.parametrize("name", ["op11_structure_repair", "op12_spelling_variants"])
def test_new_queries_agree_with_their_sql(spark, small, name):
    assert compare_oracle.difference(spark, compare_oracle.duck(small), small, name) is None


def test_kinds_are_learned_from_all_training_texts(spark):
    rows = [(at, f"w{i} x{i}", False) for at, i in enumerate(i for i in range(10) for _ in range(500 + 3 * i))]
    rows += [(-1 - i, "unseen", True) for i in range(1000)]
    kinds = context_mixing.learn_kinds(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean"))
    assert [*kinds.place] == [f"{x}{i}".encode() for i in reversed(range(10)) for x in "wx"]
    assert kinds.speaks.shape[0] == 20 and abs(np.exp(kinds.shares).sum() - 1) < 0.01
    again = context_mixing.learn_kinds(spark.createDataFrame(rows[::-1], "doc_id long, text string, held_out boolean"))
    assert kinds.place == again.place and np.array_equal(kinds.speaks, again.speaks)


def test_words_are_cut_for_many_texts_at_once(monkeypatch):
    found = ["A b\x0b\x1cÉ\x0cc ", None, "", " \t", "dd", "dd a"]
    words = context_mixing.words_of(pa.array(["x y", *found]).slice(1))
    want = [(text or "").lower().replace("é", "É").encode().split() for text in found]
    assert words.found.to_pylist() == [word for text in want for word in text]
    assert words.counts.tolist() == [len(text) for text in want] and words.text.tolist() == [0, 0, 0, 0, 4, 5, 5]
    assert words.sizes.tolist() == [sum(map(len, text)) for text in want]
    # However batches are put together and cut, a text's kind is the same.
    kinds = context_mixing.Kinds({b"a": 0, b"dd": 1}, np.array([[-0.1, -3.0], [-2.0, -0.2]]), np.log([0.6, 0.4]))
    assert kinds.of(words).tolist() == [0, 0, 0, 0, 1, 0]
    batch = pa.RecordBatch.from_arrays([pa.array(found)], ["text"])
    monkeypatch.setattr(context_mixing, "COUNTED", 8)
    blocks = list(context_mixing._blocks(iter([batch.slice(0, 2), batch.slice(2)])))
    assert [text for block in blocks for text in block.column("text").to_pylist()] == found
    assert [kind for block in blocks for kind in kinds.of(context_mixing.words_of(block.column("text")))] == [0, 0, 0, 0, 1, 0]


def test_log_odds_of_slots_give_the_same_probabilities():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 40, context_mixing._SLOTS).astype(np.uint32) << 16 | rng.integers(0, 40, context_mixing._SLOTS).astype(np.uint32)
    counts[::3] = 0
    model = context_mixing._untrained(counts)
    trie = context_mixing.lay_out([b"abc", b"abd", b"b", context_mixing.END, "été".encode()], [0, 1, 0, 1, 0])
    for _, bits, partial, slots in context_mixing._steps(trie, np.arange(len(trie.letters))):
        odds = context_mixing._slot_odds(counts)
        plain = context_mixing.bit_probabilities(model, slots, bits, partial)
        assert np.array_equal(context_mixing.bit_probabilities(model, slots, bits, partial, odds), plain)
