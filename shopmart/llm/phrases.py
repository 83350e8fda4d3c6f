"""Phrase collocation mining: frequent phrases of each language, scored by how they hold together.

Words are counted by Spark.  Then level by level, from words to the longest phrases: a broadcast
double-array trie holds the Apriori-safe candidates of k words; numpy advances the states of all text
positions at once, word by word, and positions whose phrase of k words, and whose phrase of k words one
word on, are both candidates yield a (node, next word) pair.  Pairs are summed by Spark; those that reach
the least count, joined back to their words, are the candidates of k + 1 words.  The next word goes by
its hash, which can only make a candidate too many: a last pass over the trie of all candidates bincounts
the accepting states, and the sums over all tasks are the exact counts.

A trie holds at most ``TRIE_PHRASES`` phrases.  With more candidates, as large corpora have, several tries would
mean a pass over all texts for each; then phrases go by hash (``_by_hash``): the levels' candidates are bits of
their hashes, of bounded size, so a level is one pass whatever their number, and a last pass counts the
phrases themselves, word for word, wherever the bits hold.

Defined results: a null text is empty, a null language is ``und``; repeated rows count each; a
text of any length is worked on whole, so phrases across the borders of work blocks are found.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.llm import runs
from shopmart.llm.bytehash import BASE, blocks, mix, prefix, span_hash, text_bytes
from shopmart.llm.common import cut
from shopmart.llm.double_array import DoubleArray, build
from shopmart.session import shuffles_removed

TRIE_PHRASES = 1 << 16  # the driver lays a trie out in Python; more phrases go by hash
BLOCK = 1 << 21  # bytes of text worked on at a time; the arrays of a block take tens of times as many
BATCH_ROWS = 1 << 16  # rows that leave a task at once: the JVM holds a batch outside its heap
MOST_BITS = 28  # a level's candidates are 2^28 bits (32 MB) at most, 16 for each while there are fewer
BUCKET_BITS = 15  # of a row of bits, as Spark's bitmap functions have it
WIDE = 64  # counts in a row of partial sums
BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = runs.byte_class(BREAKS)
_WORD = ~runs.byte_class(BREAKS + b" \t")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """The words of a block of texts: piece, language, and a number equal for equal words only."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        buf = _LOWER[buf]
        mask = _WORD[buf]
        starts, ends = runs.runs(mask, offsets)
        self.text = np.searchsorted(offsets, starts, "right") - 1
        self.ids, self.distinct = runs.numbered(buf, mask, ends - starts)
        breaks = np.searchsorted(np.flatnonzero(_BREAK[buf]), starts)  # before each word
        self.piece = breaks + self.text  # both only grow, so equal sums are one piece
        spelled, cuts = text_bytes(self.distinct)
        self.hashes = span_hash(prefix(spelled), cuts[:-1], cuts[1:]).view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, list]]:
    """(words, language of each text) of each block of whole texts."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        buf, offsets = text_bytes(batch.column(1))
        for lo, hi in blocks(np.diff(offsets), BLOCK):
            if offsets[hi] > offsets[lo]:
                yield _Words(buf[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]), langs[lo:hi]


def _batches(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Rows of the columns, ``BATCH_ROWS`` at a time."""
    rows = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    for lo in range(0, rows.num_rows, BATCH_ROWS):
        yield rows.slice(lo, BATCH_ROWS)


def _kept(df: DataFrame) -> DataFrame:
    """``df``, written to the shared checkpoint folder; its shuffle files go."""
    with shuffles_removed(df.sparkSession):
        return cut(df.select("*"))  # planned anew, under that setting


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, word_hash, n) of every word."""

    def counted(batches):
        for words, langs in _blocks(batches):
            names, number = np.unique(np.array(langs, object), return_inverse=True)
            keys, n = np.unique(number[words.text] * np.int64(len(words.distinct)) + words.ids,
                                return_counts=True)
            lang, word = np.divmod(keys, len(words.distinct))
            yield from _batches({
                "lang": pa.array(names[lang], pa.string()),
                "word": words.distinct.take(pa.array(word)).cast(pa.string()),
                "word_hash": pa.array(words.hashes[word]), "n": pa.array(n)})

    return (_texts(docs).mapInArrow(counted, "lang string, word string, word_hash bigint, n bigint")
            .groupBy("lang", "word", "word_hash").agg(F.sum("n").alias("n")))


class _Trie:
    """One trie of phrases (each a language and its words) with what a task needs to walk it."""

    def __init__(self, phrases: pa.Table):
        langs, words = phrases["lang"].combine_chunks(), phrases["words"].combine_chunks()
        sizes = pc.list_value_length(words).to_numpy()
        spelled = words.flatten().cast(pa.large_binary()).dictionary_encode()
        self.langs = langs.unique().to_pylist()
        self.vocabulary = spelled.dictionary
        rows = np.full((len(sizes), int(sizes.max(initial=0)) + 1), -1, np.int64)
        rows[:, 0] = pc.index_in(langs, pa.array(self.langs, langs.type)).to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        rows[row, column] = spelled.indices.to_numpy(zero_copy_only=False) + len(self.langs)
        self.depth = rows.shape[1] - 1
        self.array, self.nodes = build(rows)

    def walk(self, words: _Words, langs: list) -> Iterator[np.ndarray]:
        """Per level: the state of every position (-1: no such phrase starts there)."""
        roots = {lang: self.array.step(np.zeros(1, np.int64), np.array([i]))[0]
                 for i, lang in enumerate(self.langs)}
        by_text = np.array([roots.get(lang, -1) for lang in langs], np.int64)
        symbol = pc.index_in(words.distinct, self.vocabulary).to_numpy(zero_copy_only=False)
        symbol = np.where(np.isnan(symbol), -1, symbol + len(self.langs)).astype(np.int64)
        symbols = symbol[words.ids]
        state = self.array.step(by_text[words.text], symbols)
        for level in range(1, self.depth + 1):
            yield state
            following = np.full(len(state), -1, np.int64)
            at = np.flatnonzero(state[: len(state) - level] >= 0) if len(state) > level else state[:0]
            at = at[words.piece[at] == words.piece[at + level]]
            following[at] = self.array.step(state[at], symbols[at + level])
            state = following


def _trie(phrases: DataFrame) -> tuple[_Trie, DataFrame] | None:
    """The trie of the phrases, and the phrases with node and place among the nodes."""
    table = phrases.select("lang", "words").toArrow()
    if not table.num_rows:
        return None
    trie = _Trie(table)
    slots = np.argsort(np.argsort(trie.nodes))
    return trie, phrases.sparkSession.createDataFrame(
        table.append_column("node", pa.array(trie.nodes)).append_column("slot", pa.array(slots)))


def _extend(docs: DataFrame, phrases: DataFrame, words: DataFrame, least: int) -> DataFrame | None:
    """Candidates one word longer: (lang, words), all their shorter phrases candidates too."""
    made = _trie(phrases)
    if made is None:
        return None
    trie, names = made

    def pairs(batches):
        for block, langs in _blocks(batches):
            for state in trie.walk(block, langs):
                pass
            size = trie.depth
            if len(state) <= size:
                continue
            at = np.flatnonzero(state[:-size] >= 0)
            at = at[block.piece[at] == block.piece[at + size]]
            at = at[state[at + 1] >= 0]
            spelled = np.int64(len(block.distinct))
            keys, n = np.unique(state[at] * spelled + block.ids[at + size], return_counts=True)
            node, word = np.divmod(keys, spelled)
            yield from _batches({
                "node": pa.array(node), "word_hash": pa.array(block.hashes[word]), "n": pa.array(n)})

    often = (_texts(docs).mapInArrow(pairs, "node bigint, word_hash bigint, n bigint")
             .groupBy("node", "word_hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
    longer = (often.join(names, "node").join(words, ["lang", "word_hash"])
              .select("lang", F.concat("words", F.array("word")).alias("words")))
    return _kept(longer)


def _counted(docs: DataFrame, phrases: DataFrame) -> DataFrame | None:
    """(lang, words, a): the exact count of each candidate phrase.

    A task's sums leave it as rows of ``WIDE`` neighbouring counts each, which Spark
    adds column by column.
    """
    made = _trie(phrases)
    if made is None:
        return None
    trie, names = made
    columns = [f"c{i}" for i in range(WIDE)]

    def states(batches):
        total = np.zeros(len(trie.array.check), np.int64)
        for block, langs in _blocks(batches):
            reached = [state[state >= 0] for state in trie.walk(block, langs)]
            total += np.bincount(np.concatenate(reached), minlength=len(total))
        sums = total[np.sort(trie.nodes)]  # of accepting states, not of mere beginnings
        sums = np.append(sums, np.zeros(-len(sums) % WIDE, np.int64)).reshape(-1, WIDE)
        chunks = np.flatnonzero(sums.any(axis=1))
        for lo in range(0, len(chunks), 4096):
            part = chunks[lo: lo + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array(c) for c in sums[part].T)], ["chunk", *columns])

    sums = (_texts(docs).mapInArrow(states, ", ".join(f"{c} bigint" for c in ["chunk", *columns]))
            .groupBy("chunk").agg(*(F.sum(c).alias(c) for c in columns))
            .select("chunk", F.posexplode(F.array(*columns)).alias("place", "a"))
            .select((F.col("chunk") * WIDE + F.col("place")).alias("slot"), "a"))
    return _kept(sums.join(names, "slot").select("lang", "words", "a"))


class _Bits:
    """Hashes as bits, two each: every hash put in is found, and few others."""

    def __init__(self, hashes: DataFrame, count: int):
        self.size = min(MOST_BITS, max(BUCKET_BITS, (16 * count).bit_length()))
        slots = F.array(F.shiftrightunsigned("h", 64 - self.size), F.col("h").bitwiseAND(F.lit((1 << self.size) - 1)))
        slot = F.col("slot")
        rows = (hashes.select(F.explode(slots).alias("slot"))
                .select(F.shiftright(slot, BUCKET_BITS).alias("bucket"),
                        slot.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).alias("place"))
                .repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")))
        width = 1 << BUCKET_BITS - 3
        self.bits = np.zeros(1 << self.size - 3, np.uint8)
        table = rows.toArrow()
        for bucket, bits in zip(table["bucket"].to_pylist(), table["bits"]):
            self.bits[bucket * width: (bucket + 1) * width] = np.frombuffer(bits.as_buffer(), np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        one, two = hashes >> np.uint64(64 - self.size), hashes & np.uint64((1 << self.size) - 1)
        seven = np.uint64(7)
        return ((self.bits[one >> np.uint64(3)] >> (one & seven)) & (self.bits[two >> np.uint64(3)] >> (two & seven))
                & 1).astype(bool)


def _word_hashes(spelled: np.ndarray, langs: list, which: np.ndarray) -> np.ndarray:
    """Hashes of words of a language, from those of the words and the language of each."""
    lang = mix(np.array([zlib.crc32(name.encode()) for name in langs], np.uint64))
    return mix(spelled ^ lang[which])


def _walk_bits(words: _Words, langs: list, levels: list[_Bits]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per level of 1, 2, ... words: where phrases start that the bits hold, as all shorter ones inside do, and their hashes."""
    spelled = words.hashes.view(np.uint64)[words.ids]
    hashes = _word_hashes(spelled, langs, words.text)
    at = np.flatnonzero(levels[0].has(hashes))
    yield at, hashes[at]
    for size, bits in enumerate(levels[1:], 1):
        at, found = _longer(words, spelled, at, hashes, size)
        good = bits.has(found)
        at = at[good]
        hashes[at] = found[good]
        yield at, hashes[at]


def _longer(words: _Words, spelled: np.ndarray, at: np.ndarray, hashes: np.ndarray,
            size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of phrases of ``size`` + 1 words whose two phrases of ``size`` words start at ``at``, and their hashes."""
    known = np.zeros(len(words.ids) + 1, bool)
    known[at] = True
    at = at[known[at + 1] & (at + size < len(words.ids))]
    at = at[words.piece[at] == words.piece[at + size]]
    return at, mix(hashes[at] * np.uint64(BASE) + spelled[at + size])


def _by_hash(docs: DataFrame, words: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, words, a) of every phrase of 2 to ``longest`` words with a >= least: one pass a level, one for the counts.

    ``words`` are those that come often enough.
    """
    levels: list[_Bits] = []

    def alone(batches):
        for batch in batches:
            langs, which = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            hashes = _word_hashes(batch.column(1).to_numpy().view(np.uint64), list(langs), which)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["h"])

    def grams(batches):  # of one word more than there are levels
        for block, langs in _blocks(batches):
            full = np.zeros(len(block.ids), np.uint64)
            for at, hashes in _walk_bits(block, langs, levels):
                full[at] = hashes
            spelled = block.hashes.view(np.uint64)[block.ids]
            keys, n = np.unique(_longer(block, spelled, at, full, len(levels))[1], return_counts=True)
            yield from _batches({"h": pa.array(keys.view(np.int64)), "n": pa.array(n)})

    def counted(batches):
        for block, langs in _blocks(batches):
            names, number = np.unique(np.array(langs, object), return_inverse=True)
            spelled = np.int64(len(block.distinct))
            phrase = number[block.text] * spelled + block.ids  # a number equal for equal phrases only
            for size, (at, _) in enumerate(_walk_bits(block, langs, levels), 1):
                if size > 1:
                    phrase[at] = phrase[at] * spelled + block.ids[at + size - 1]
                _, first, own, n = np.unique(phrase[at], return_index=True, return_inverse=True, return_counts=True)
                phrase[at] = own
                if size > 1 and len(first):
                    first = at[first]
                    parts = [block.distinct.take(pa.array(block.ids[first + i])) for i in range(size)]
                    yield from _batches({
                        "lang": pa.array(names[number[block.text[first]]], pa.string()),
                        "phrase": pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
                        .cast(pa.large_string()).cast(pa.string()),
                        "n": pa.array(n)})

    for size in range(1, longest + 1):
        often = words.select("lang", "word_hash").mapInArrow(alone, "h bigint") if size == 1 else (
            _texts(docs).mapInArrow(grams, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least).select("h"))
        often = _kept(often)
        count = often.count()
        if not count:
            break
        levels.append(_Bits(often, count))
    if len(levels) < 2:
        return words.select("lang", F.array("word").alias("words"), F.lit(0).cast("bigint").alias("a")).limit(0)
    phrases = (_texts(docs).mapInArrow(counted, "lang string, phrase string, n bigint")
               .groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least))
    return _kept(phrases.select("lang", F.split("phrase", " ").alias("words"), "a"))


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n of every word; lang, words, a of every phrase of 2 to ``longest`` words with a >= least)."""
    every_word = _kept(count_words(docs))
    often = (every_word.where(F.col("n") >= least).select("lang", "word", "word_hash"))
    level = often.select("lang", F.array("word").alias("words"))
    candidates, total = None, 0
    for size in range(2, longest + 1):
        rows = level.count()
        total += rows if size > 2 else 0
        if max(rows, total) > TRIE_PHRASES:
            return every_word, _by_hash(docs, often, least, longest)
        longer = _extend(docs, level, often, least)
        if longer is None:
            break
        level = longer
        candidates = level if candidates is None else candidates.unionByName(level)
    if total + level.count() > TRIE_PHRASES:
        return every_word, _by_hash(docs, often, least, longest)
    counted = _counted(docs, candidates) if candidates is not None else None
    if counted is None:
        counted = level.limit(0).withColumn("a", F.lit(0).cast("bigint"))
    return every_word, counted.where(F.col("a") >= least)


def mine_phrases(docs: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000,
                 absorbed: int = 100) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``n`` counts the language's words and ``a`` the phrase.  A cut into two parts of counts l and r scores
    floor(1000 * a * n / (l * r)); the least cut counts, the first of equal ones.  A phrase goes when a longer
    one that holds it has at least ``absorbed`` percent of its count; as a phrase between the two has a
    count between theirs, looking at one word more is enough.
    """
    every_word, counted = frequent_phrases(docs, min_count, longest)
    name = lambda words: F.array_join(words, " ")
    phrases = counted.select("lang", "words", name(F.col("words")).alias("phrase"), "a")
    known = phrases.select("lang", "phrase", "a").unionByName(
        every_word.groupBy("lang", "word").agg(F.sum("n").alias("a"))
        .where(F.col("a") >= min_count).withColumnRenamed("word", "phrase"))
    totals = every_word.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = (phrases.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
            .select("lang", "phrase", "a", "k", name(F.expr("slice(words, 1, k)")).alias("head"),
                    name(F.expr("slice(words, k + 1, size(words) - k)")).alias("tail")))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    wide = "cast({} as decimal(19, 0))"
    score = F.expr(f"({wide.format('1000 * a')} * {wide.format('n')}) div "
                   f"({wide.format('l')} * {wide.format('r')})")
    best = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
            .groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))
    inside = (phrases.where(F.size("words") > 2)
              .select("lang", F.col("a").alias("longer"), F.explode(F.array(
                  name(F.expr("slice(words, 1, size(words) - 1)")),
                  name(F.expr("slice(words, 2, size(words) - 1)")))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = (best.join(inside, ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("longer") < absorbed * F.col("a"), F.lit(True))))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.desc("cut.score"), F.desc("a"), "phrase"))
    return (left.withColumn("rank", place).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
                    "cut.score"))


ORACLE = r"""
WITH pieces AS (SELECT rid, lang, unnest(ps) AS piece, unnest(range(len(ps))) AS pid FROM (
 SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(
  coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
 FROM documents)),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
 FROM split, unnest(range(1, 6)) AS s(m), unnest(range(1, len(w) - m + 2)) AS t(i)),
known AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM split GROUP BY lang),
cuts AS (SELECT lang, m, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
 array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS tail
 FROM known, unnest(range(1, m)) AS c(k) WHERE m >= 2),
scored AS (SELECT c.*, h.a AS l, t.a AS r, n, (1000 * c.a * n) // (h.a * t.a) AS score FROM cuts c
 JOIN known h ON h.lang = c.lang AND h.phrase = c.head JOIN known t ON t.lang = c.lang AND t.phrase = c.tail
 JOIN totals ON totals.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT lang, a, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS phrase
 FROM known, unnest(range(2, m)) AS x(s), unnest(range(1, m - s + 2)) AS y(i) WHERE m >= 3),
absorbed AS (SELECT DISTINCT k.lang, k.phrase FROM known k JOIN parts p ON p.lang = k.lang AND p.phrase = k.phrase
 WHERE 100 * p.a >= 100 * k.a),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
 FROM best b WHERE NOT EXISTS (SELECT 1 FROM absorbed x WHERE x.lang = b.lang AND x.phrase = b.phrase))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
 CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
