"""Perplexity rules, phrase mining and conversation repair against brute force."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopmart.llm import conversation_repair, double_array, perplexity, phrases, queries, runs
from shopmart.llm.bytehash import text_bytes
from tests.llm.conftest import LONG, ODD_ROWS, SF_SMALL, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    where = defaultdict(list)
    for i in range(len(words) - 4):
        where[tuple(words[i:i + 5])].append(i)
    hit = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(hit))


def brute_model(texts):
    """Modified Kneser-Ney in plain dictionaries: a function (4 symbols) → log p."""
    def off(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not all(n):
            return lambda c: (0, 0.5, 1.0, 1.5)[min(c, 3)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [0, 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        return lambda c: min(max(d[min(c, 3)], 0), min(c, 3))

    symbols = [[int(perplexity.CLASS[b]) for b in (t or "").encode()] for t in texts]
    level = {4: Counter(tuple(s[i:i + 4]) for s in symbols for i in range(len(s) - 3))}
    for k in (3, 2, 1):
        level[k] = Counter(g[1:] for g in level[k + 1])
    offs = {k: off(level[k].values()) for k in level}
    by_context = {k: defaultdict(list) for k in level}
    for k in level:
        for g, c in level[k].items():
            by_context[k][g[:-1]].append(c)

    def p(gram):
        if not gram:
            return 1 / perplexity.SYMBOLS
        k, lower = len(gram), p(gram[1:])
        counts = by_context[k].get(gram[:-1])
        if not counts:
            return lower
        c = level[k].get(gram, 0)
        gave = sum(offs[k](x) for x in counts) / sum(counts)
        return (c - (offs[k](c) if c else 0)) / sum(counts) + gave * lower

    return p, symbols


def test_op11_base_columns_equal_brute_force(spark, texts):
    got = {r.doc_id: r for r in queries.op11_quality_rules(spark, SF_SMALL).collect()}
    assert set(got) == set(texts)
    for d, text in texts.items():
        want = brute_measures(text)
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


ODD_TEXTS = ["", "a", "a\na\na", "x y z x y\tz x y z x y z", "one\n\n two\none\n two\n", "\n\n", "é é#|",
             "w " * 30, "a b c d e f\na b c d e f", "x\x0by\x0cz", "aa bb\r\naa bb\r\n", " lead\nlead\n lead"]


def test_measures_of_odd_texts_and_block_borders(monkeypatch):
    rng = random.Random(3)
    texts = ODD_TEXTS + ["".join(rng.choice("ab \n") for _ in range(rng.randrange(60))) for _ in range(300)]
    buf, offsets = text_bytes(pa.array(texts))
    found = perplexity.base_measures(buf, offsets)
    rows = list(zip(*(found[m].tolist() for m in perplexity._MEASURES[:5])))
    assert rows == [brute_measures(t) for t in texts]
    whole = Counter(c for _, part in perplexity.ngram_codes(buf, offsets) for c in part.tolist())
    monkeypatch.setattr(runs, "BLOCK", 37)
    assert whole == Counter(c for _, part in perplexity.ngram_codes(buf, offsets) for c in part.tolist())


def test_model_equals_brute_force(docs, texts):
    some = dict(sorted(texts.items())[:25])
    part = docs.where(F.col("doc_id").isin(*some)).distinct()
    model = perplexity.train(part)
    p, symbols = brute_model(some.values())
    rows = perplexity.measure_documents(part.select("doc_id", "lang", "text"), model).collect()
    for r in rows[:6]:
        s = [int(perplexity.CLASS[b]) for b in r.text.encode()]
        want = sum(math.log(p(tuple(s[i:i + 4]))) for i in range(len(s) - 3))
        assert r.measures.n_grams == max(0, len(s) - 3)
        assert r.measures.log_prob == pytest.approx(want, rel=1e-4)
    rng = random.Random(1)
    grams = [tuple(rng.randrange(perplexity.SYMBOLS) for _ in range(4)) for _ in range(300)]  # mostly unseen
    codes = np.array([((a * perplexity.SYMBOLS + b) * perplexity.SYMBOLS + c) * perplexity.SYMBOLS + d
                      for a, b, c, d in grams])
    assert np.allclose(model.score(codes), [math.log(p(g)) for g in grams], atol=1e-4)
    for context in [g[:3] for g in grams[:3]] + [tuple(symbols[0][:3])]:  # probabilities add up to one
        assert sum(p((*context, w)) for w in range(perplexity.SYMBOLS)) == pytest.approx(1)


def test_clean_documents_stay_and_gibberish_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    rng = random.Random(5)
    noise = [(10 ** 6 + i, "en", " ".join("".join(rng.choice("qxzjkwvQXZ0938") for _ in range(7))
                                           for _ in range(120))) for i in range(10)]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality").distinct()
    got = perplexity.judge(docs.unionByName(spark.createDataFrame(noise, docs.schema))).cache()
    assert got.where((F.col("doc_id") >= 10 ** 6) & F.col("kept")).count() == 0
    clean = got.join(labels.where("quality = 1"), "doc_id").where(~F.col("base_failed"))
    assert clean.where(F.col("kept")).count() >= 0.99 * clean.count()
    junk = got.join(labels.where("quality = 0"), "doc_id")
    assert junk.where(~F.col("kept")).count() >= 0.5 * junk.count()


def test_op11_odd_rows(spark, odd, empty):
    rows = odd.withColumn("lang", F.when(F.col("doc_id") == 4, None).otherwise("en"))
    got = perplexity.judge(rows).collect()
    assert len(got) == len(ODD_ROWS)
    assert Counter((r.doc_id, r.measures.n_words) for r in got) == Counter(
        (d, len(WORD.findall(t or ""))) for d, t in ODD_ROWS)
    assert {r.base_failed for r in got if r.doc_id in (4, 8)} == {True}
    assert perplexity.judge(empty.withColumn("lang", F.lit("en"))).count() == 0


def test_each_byte_is_a_symbol(spark):
    """Digits, capitals and marks are told apart, as are the bytes of other scripts."""
    texts = ["1234", "4321", "ABCD", "DCBA", "()[]", "{}()", "中文", "文中", "\x01\x02\x03\x04", "\x05\x06\x07\x08"]
    found = perplexity.count_ngrams(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.code for r in found} == {int.from_bytes(t.encode()[i:i + 4]) for t in texts
                                       for i in range(len(t.encode()) - 3)}
    usual = "the price is 1000 and no more " * 20
    docs = spark.createDataFrame([(i, "en", usual) for i in range(9)] + [(9, "en", usual.replace("1000", "7394"))],
                                 "doc_id long, lang string, text string")
    got = perplexity.measure_documents(docs, perplexity.train(docs)).collect()
    other = {r.doc_id: r.measures.log_prob for r in got}
    assert other[9] < other[0] - 1


def test_rare_ngrams_are_joined_as_rows(spark, odd, monkeypatch):
    rows = odd.select("doc_id", "text")
    model = perplexity.train(rows)
    whole = perplexity.measure_documents(rows, model).collect()
    monkeypatch.setattr(perplexity, "HELD", 20)
    monkeypatch.setattr(perplexity, "COUNTED", 16)
    split = perplexity.measure_documents(rows, perplexity.train(rows)).collect()
    show = lambda found: sorted((str(r.doc_id), str(r.text), r.measures[:6], round(r.measures.log_prob, 2)) for r in found)
    assert show(split) == show(whole) and len(split) == len(ODD_ROWS)


def test_double_array_finds_all_rows_and_no_others():
    rng = np.random.default_rng(7)
    rows = np.unique(rng.integers(0, 40, (3000, 4)), axis=0)
    sizes = rng.integers(1, 5, len(rows))
    rows[np.arange(4)[None, :] >= sizes[:, None]] = -1
    rows = np.unique(rows, axis=0)
    array, nodes = double_array.build(rows)
    assert len(set(nodes.tolist())) == len(rows)

    def walk(many):
        state = np.zeros(len(many), np.int64)
        for column in many.T:
            state = np.where(column >= 0, array.step(state, column), state)
        return state

    assert (walk(rows) == nodes).all()
    prefixes = {tuple(r[:k]) for r in rows.tolist() for k in range(1, 5) if min(r[:k]) >= 0}
    tried = rng.integers(0, 45, (3000, 4))
    assert [s >= 0 for s in walk(tried)] == [tuple(t) in prefixes for t in tried.tolist()]
    empty, none = double_array.build(np.zeros((0, 3), np.int64))
    assert len(none) == 0 and empty.step(np.zeros(1, np.int64), np.array([0]))[0] == -1


def brute_phrases(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    often = {g: c for g, c in counts.items() if c >= least}
    gone = {(lang, w[i:i + k]) for (lang, w), c in often.items() for k in range(2, len(w))
            for i in range(len(w) - k + 1) if c >= often[lang, w[i:i + k]]}
    found = defaultdict(list)
    for (lang, w), a in often.items():
        if len(w) > 1 and (lang, w) not in gone:
            score, k = min((math.floor(Fraction(1000 * a * totals[lang],
                                                often[lang, w[:k]] * often[lang, w[k:]])), k)
                           for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), often[lang, w[:k]], often[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, totals[lang], -s) for lang, rows in found.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


PHRASE_ROWS = ([("en", "New York is big. new york, New York city! x")] * 7
               + [(None, "a b a b a b\na b")] * 3 + [("und", "A B a\tb;a b c d e f g")] * 4
               + [("en", None), ("en", ""), (None, None), ("de", " . , "), ("de", "x" * 70 + " y")]
               + [("en", "é ß é ß é ß NEW york"), ("fr", "y y y y y y y y"), ("en", LONG)])


@pytest.mark.parametrize("per_trie", [1 << 19, 3])
def test_phrases_equal_brute_force(spark, monkeypatch, per_trie):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", per_trie)
    rows = PHRASE_ROWS if per_trie > 3 else PHRASE_ROWS[:7] + PHRASE_ROWS[7:11]
    docs = with_clashes(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    got = sorted(map(tuple, phrases.mine_phrases(docs, min_count=4, longest=5, top=20).collect()))
    assert got == brute_phrases(rows, 4, 5, 20)
    assert got


def test_phrases_of_documents_and_of_nothing(spark, docs, empty):
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    got = sorted(map(tuple, phrases.mine_phrases(docs, min_count=12, longest=5, top=300).collect()))
    assert got == brute_phrases(rows, 12, 5, 300)
    assert phrases.mine_phrases(empty.withColumn("lang", F.lit("en"))).count() == 0


@pytest.mark.parametrize("most_bits", [28, 15])
def test_more_phrases_than_a_trie_holds_take_one_pass_a_level(spark, docs, monkeypatch, most_bits):
    """Passes over the texts don't grow with the candidates; bits that are full make no phrase too many."""
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 20)
    monkeypatch.setattr(phrases, "MOST_BITS", most_bits)
    passes, texts = [], phrases._texts
    monkeypatch.setattr(phrases, "_texts", lambda df: passes.append(1) or texts(df))
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    got = sorted(map(tuple, phrases.mine_phrases(docs, min_count=12, longest=5, top=300).collect()))
    assert got == brute_phrases(rows, 12, 5, 300)
    assert len(passes) == 1 + 4 + 1  # words, the levels of two words and more, counts


def test_phrase_blocks_bound_a_task():
    """The arrays of a task follow the block of text and leave it in small batches."""
    texts = [" ".join(f"w{i % 4999}, x" for i in range(j, j + 100_000)) for j in range(12)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 12), pa.array(texts)], ["lang", "text"])
    del texts
    tracemalloc.start()
    n = sum(len(words.ids) for words, _ in phrases._blocks(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 12 * 200_000
    assert peak < 80 << 20
    numbers = pa.array(np.arange(200_001))
    parts = list(phrases._batches({"n": numbers}))
    assert max(part.num_rows for part in parts) <= 1 << 16
    assert pa.concat_arrays([part.column(0) for part in parts]).equals(numbers)


def test_phrase_scores_pass_64_bits(spark, monkeypatch):
    big = 4 * 10 ** 12
    words = spark.createDataFrame([("en", w, 0, big) for w in "ab"], "lang string, word string, word_hash long, n long")
    counted = spark.createDataFrame([("en", ["a", "b"], big - 1)], "lang string, words array<string>, a long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: (words, counted))
    assert phrases.mine_phrases(None).first().score == 1000 * (big - 1) * 2 * big // (big * big)


def brute_repair(rows):
    """Cheapest (cost, audit, text) over all edits with at most one insert a gap, two at the ends."""
    ends = {0: [], 3: []}
    step = conversation_repair.NEXT

    def go(i, state, cost, audit, lines, inserts):
        if cost > 5 * len(rows) + 12:
            return
        if i == len(rows):
            if state in ends:
                ends[state].append((cost, audit, "\n".join(lines)))
        else:
            role, text, fault = rows[i]
            go(i + 1, state, cost + 2, audit + "D", lines, 0)
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if (state, role[:1]) in step:
                    go(i + 1, step[state, role[:1]], cost + extra, audit + "K", lines + [f"{role}:{text}"], 0)
                for c, name in conversation_repair.ROLES.items():
                    if (state, c) in step:
                        go(i + 1, step[state, c], cost + 1 + extra, audit + "R", lines + [f"{name}:{text}"], 0)
        if inserts < 2:
            for c, name in conversation_repair.ROLES.items():
                if (state, c) in step:
                    go(i, step[state, c], cost + 5, audit + "I", lines + [f"{name}:"], inserts + 1)

    go(0, 0, 0, "", [], 0)
    return min(ends[0] + ends[3])


def repaired(rows):
    repairer = conversation_repair.Repairer()
    edits = [e for role, text, fault in rows for e in repairer.feed(
        None, role, text, fault in ("blank", "duplicate"), fault == "truncated")]
    edits += repairer.finish()
    return (repairer.cost, "".join(e[0] for e in edits),
            "\n".join(f"{e[2]}:{e[3]}" for e in edits if e[2] is not None))


def test_repair_equals_exhaustive_search():
    rng = random.Random(11)
    for size in (0, 1, 2):
        for roles in itertools.product(["system", "user", "assistant", "tool"], repeat=size):
            for faults in itertools.product(["", "blank", "truncated"], repeat=size):
                rows = [(r, f"t{i}", f) for i, (r, f) in enumerate(zip(roles, faults))]
                assert repaired(rows) == brute_repair(rows)
    for _ in range(250):
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", " ", ""]), f"t{i}",
                 rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for i in range(rng.randrange(3, 6))]
        assert repaired(rows) == brute_repair(rows)


def test_repair_holds_only_what_is_unresolved():
    rng = random.Random(2)
    repairer, most, emitted = conversation_repair.Repairer(), 0, 0
    for i in range(30000):
        role = rng.choice(["user", "assistant"]) if i % 7 else "system"
        emitted += len(list(repairer.feed(None, role, "x.", rng.random() < 0.05, rng.random() < 0.05)))
        if i % 500 == 0:
            nodes, todo = 0, [repairer.root]
            while todo:
                nodes += 1
                todo += todo.pop().kids
            most = max(most, nodes)
    assert most < 400 and emitted > 29000


TURNS = [(1, 0, "user", "Hi there."), (1, 1, "assistant", "Hello."), (1, 1, "assistant", "Hello."),
         (1, None, "system", "Be kind."), (1, 5, "user", None), (1, 6, None, "who?"), (1, 7, "user", "cut off"),
         (2, None, None, None), (None, 3, "user", "No id."), (None, 4, "assistant", "Neither has."),
         (3, 2, "assistant", "ends ok?"), (4, 0, "user", "same."), (4, 0, "user", "same."), (5, 9, "", "x."),
         (6, 0, "user", LONG + "."), (6, 1, "assistant", LONG), (6, 2, "user", "\t\n ")]


def brute_report(rows, dropped):
    out = {}
    by_conv = defaultdict(list)
    for (conv, turn, role, text), gone in zip(rows, dropped):
        by_conv[conv] += [] if gone else [(turn, " " if role is None else role, " " if text is None else text)]
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, told = set(), [], []
        for _, role, text in own:
            bare = text.rstrip(conversation_repair.BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        marks = [r[:1] for _, r, _ in own]
        cost, audit, text = repaired([(r, t, f) for (_, r, t), f in zip(own, faults)])
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:])), cost, audit, sha(text))
    return out


def damaged(rows):
    out, gone = [], []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        text = " " if text is None else text
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        for _ in range(2 if case == 3 else 1):
            out.append((conv, turn, "user" if case == 4 else role, text))
            gone.append(case == 0)
    return out, gone


def test_op13_odd_rows_equal_brute_force(spark):
    table = with_clashes(spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string"))
    got = {r[0]: tuple(r[1:]) for r in conversation_repair.report(table).collect()}
    assert got == brute_report(TURNS, [False] * len(TURNS))
    got = {r[0]: tuple(r[1:]) for r in conversation_repair.report(
        conversation_repair.damage(table), F.col("dropped")).collect()}
    assert got == brute_report(*damaged(TURNS))
    assert conversation_repair.report(table.limit(0)).count() == 0
    all_gone = conversation_repair.report(conversation_repair.clean_rows(table), F.lit(True)).collect()
    assert {tuple(r[1:]) for r in all_gone} == {(0, 0, 0, 0, 0, 0, "", sha(""))} and len(all_gone) == 7


def test_op13_tables_and_repaired_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[1:]) for r in queries.op13_conversation_repair(spark, SF_SMALL).collect()}
    assert got == brute_report(*damaged(rows))
    table = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    want = {r.conv_id: (r.audit, r.repaired_sha256) for r in conversation_repair.report(table).collect()}
    edits = defaultdict(list)
    for r in conversation_repair.repair(table).orderBy("conv_id", "step").collect():
        edits[r.conv_id].append(r)
    for conv, (audit, digest) in want.items():
        assert "".join(e.edit for e in edits[conv]) == audit
        assert sha("\n".join(f"{e.role}:{e.text}" for e in edits[conv] if e.role is not None)) == digest


@pytest.mark.parametrize("name", ["op12_phrase_mining", "op13_conversation_repair"])
def test_sql_oracles(spark, name):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = db.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
