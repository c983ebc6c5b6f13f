"""Phrase collocation mining by dynamic itemset counting.

Documents are dealt to shards, which are scanned in a cycle.  All words are counted from
the first step on; a longer phrase becomes active as soon as the counts so far of both its
subphrases (without the last and without the first word) have reached the threshold, and
is counted from the next step on, through shards where shorter phrases are still being
counted, until it has seen every shard once.  Lengths are thus interleaved and hardly any
data is scanned once for each length.

Which phrases have reached the threshold is handed to the tasks as a bit filter of a
bounded size (``MOST_BITS``).  Bits are only ever added, so "active" never turns back, and
a phrase is counted in a shard at the first visit at which it is active: active now, but not
``shards`` steps ago.  A wrong yes of the filter makes a phrase be counted that need not be;
it never changes a count.  Counts are exact up to collisions of 64-bit phrase hashes.

Counts move as one row per task and phrase and are summed by Spark; phrases that have
completed their cycle below the threshold are dropped.  Texts are read again only for the
phrases that may be returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from usagelake.llm.common import (
    CHUNK_BYTES, arrow_limits, by_weight, delete_folder, drop_staged, merged, slices, staged, utf8)
from usagelake.llm.words import _BASE, hash_spans, mix, split_words
from usagelake.session import shared_dir

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
SHARDS = 3
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
FLUSH = 1 << 21
NO_LANG = "und"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What ends a piece, and what stands between words of a piece.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
WORD_GAP = b" \t"
_END = np.zeros(256, bool)
_END[list(PIECE_END)] = True
_STOP = _END.copy()
_STOP[list(WORD_GAP)] = True
_TOKENS = "lang string, n long, words array<long>, shard int, part int"
# 64 slots of documents in parts of growing size: phrases are looked up in a small part first
PART = [0] + [1] * 3 + [2] * 12 + [3] * 48


def _words(buf: np.ndarray, off: np.ndarray, langs: list[str]):
    """Words of documents: lower-cased bytes, starts, ends, hashes (with the language), whether
    the piece ends after a word, and the first word of each document."""
    low = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    starts, ends, first = split_words(low, off, _STOP)
    n = len(starts)
    if n == 0:
        return low, starts, ends, np.zeros(0, np.uint64), np.zeros(0, bool), first
    seeds = {lang: xxh64_intdigest(lang.encode()) for lang in set(langs)}
    seed = np.array([seeds[lang] for lang in langs], np.uint64)
    h = mix(hash_spans(low, starts, ends) + np.repeat(seed, np.diff(first)))
    h &= ~np.uint64(1)  # even hashes are words, odd ones longer phrases
    h[h == 0] = 2
    piece = np.cumsum(_END[low], dtype=np.int64)[starts]
    stop = np.ones(n, bool)
    stop[:-1] = piece[1:] != piece[:-1]
    stop[first[1:][first[1:] > 0] - 1] = True
    return low, starts, ends, h, stop, first


def _stream(h: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with a 0 after every piece, and the place of each word in them."""
    place = np.arange(len(h)) + np.concatenate([[0], np.cumsum(stop[:-1])]) if len(h) else np.zeros(0, np.int64)
    out = np.zeros(len(h) + int(stop.sum()), np.uint64)
    out[place] = h
    return out, place


def _tokens(docs: DataFrame, shards: int) -> tuple[DataFrame, str]:
    """Written table of the word hashes of every document, one folder a shard and part."""
    spark = docs.sparkSession
    arrow_limits(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    slot = F.pmod(F.xxhash64("doc_id", text), F.lit(shards * len(PART))).cast("int")
    rows = docs.select(text.alias("text"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), (slot % shards).alias("shard"),
                       F.element_at(F.array(*map(F.lit, PART)), F.floor(slot / shards).cast("int") + 1).alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = utf8(b.column(0))
            langs = b.column(1).to_pylist()
            for i, j in slices(off):
                _, _, _, h, stop, first = _words(buf[off[i]:off[j]], off[i:j + 1] - off[i], langs[i:j])
                out, place = _stream(h, stop)
                cut = np.append(place, len(out))[first]
                words = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(out.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs[i:j], pa.string()), pa.array(np.diff(first)), words,
                     b.column(2).slice(i, j - i), b.column(3).slice(i, j - i)], ["lang", "n", "words", "shard", "part"])

    path = shared_dir(spark, f"llm-words-{uuid.uuid4().hex}")
    rows.mapInArrow(run, _TOKENS).write.partitionBy("shard", "part").parquet(path)
    return spark.read.schema(_TOKENS).parquet(path), path


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter holds each hash (never a wrong no)."""
    mask = np.uint64(len(bits) * 8 - 1)
    p, q = h & mask, (h >> np.uint64(32)) & mask
    seven, three = np.uint64(7), np.uint64(3)
    at_p = bits[p >> three] >> (p & seven).astype(np.uint8)
    at_q = bits[q >> three] >> (q & seven).astype(np.uint8)
    return (at_p & at_q & np.uint8(1)).astype(bool)


def _active(w: np.ndarray, new: np.ndarray, old: np.ndarray | None, longest: int):
    """Active phrases of a word stream by length -> ``k, places, hashes, active under old``.

    Words are active.  A phrase of k >= 2 words is active under a filter if both its
    subphrases are active under it and held by it.
    """
    at = np.flatnonzero(w)
    h = w[at]
    was = np.full(len(h), old is not None)
    for k in range(2, longest + 1):
        inside = _has(new, h)
        at, h, was = at[inside], h[inside], was[inside]
        if old is not None:
            was = was & _has(old, h)
        pair = np.flatnonzero(np.diff(at) == 1)
        at, was = at[pair], was[pair] & was[pair + 1]
        h = mix(h[pair] * _BASE + w[at + k - 1]) | np.uint64(1)
        yield k, at, h, was


def _step(tokens: DataFrame, new, old, first: bool, longest: int) -> DataFrame:
    """Counts of the phrases that a shard's visit adds -> ``h, n``, one row a task and phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(h), 1 << 17):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[i:i + (1 << 17)].view(np.int64)), pa.array(n[i:i + (1 << 17)])], ["h", "n"])

        for t in merged(batches, 8 * CHUNK_BYTES):
            w = pc.list_flatten(t.column(0).combine_chunks()).to_numpy(zero_copy_only=False).view(np.uint64)
            found = [w[w != 0]] if first else []
            found += [h[~was] for _, _, h, was in _active(w, new.value, old.value if old else None, longest)]
            held += found
            size += sum(map(len, found))
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return tokens.select("words").mapInArrow(run, "h long, n long")


def _bits(hashes: DataFrame, size: int) -> np.ndarray:
    """Filter of ``size`` bits that holds column ``h``; at most size / 64 rows reach the driver."""
    mask = F.lit(size - 1)
    place = F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask)))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    cells = (hashes.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("cell"))
             .agg(F.bit_or(one).alias("bits")).toArrow())
    out = np.zeros(size // 64, "<u8")
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def _size(n: int, least: int = LEAST_BITS) -> int:
    return min(max(1 << max(int(n) - 1, 0).bit_length(), least), MOST_BITS)


def frequent_phrases(tokens: DataFrame, words: int, min_count: int, longest: int, shards: int) -> DataFrame:
    """Exact counts of all phrases of 1 to ``longest`` words with ``min_count`` or more -> ``h, n``."""
    spark = tokens.sparkSession
    size = _size(words // 16)
    filters = [np.zeros(size // 8, np.uint8)]  # the filter at the start of each step; older ones are let go
    counts, t = None, 0
    while True:
        new, old = filters[-1], filters[-1 - shards] if t >= shards else None
        if old is not None and np.array_equal(new, old):
            filters.append(new)  # nothing became active since this shard's last visit
        else:
            sent = [spark.sparkContext.broadcast(f) for f in ([new] if old is None else [new, old])]
            step = _step(tokens.where(F.col("shard") == t % shards), sent[0], sent[1] if old is not None else None,
                         t < shards, longest)
            step = step.withColumn("since", F.lit(t))
            both = step if counts is None else step.unionByName(counts)
            out = both.groupBy("h").agg(F.sum("n").alias("n"), F.min("since").alias("since"))
            # a phrase first met at step s has seen all shards by step s + shards - 1
            out = staged(out.where((F.col("n") >= min_count) | (F.col("since") + shards - 1 > t)), "phrases")
            if counts is not None:
                drop_staged(counts)
            counts = out
            for s in sent:
                s.destroy()
            filters.append(new | _bits(counts.where(F.col("n") >= min_count), size))
        t += 1
        filters[:-1 - shards] = []
        if t >= shards and np.array_equal(filters[-1], filters[-1 - shards]):
            return counts.where(F.col("n") >= min_count).select("h", "n")


def _structure(tokens: DataFrame, known, wanted, longest: int) -> DataFrame:
    """``h, lang, pre, post`` of the phrases that the filter ``wanted`` holds (and some others): hashes of
    the first parts and of the rests of all cuts.  ``known`` holds all frequent phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in merged(batches, 8 * CHUNK_BYTES):
            lists = t.column(1).combine_chunks()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            start = np.concatenate([[0], np.cumsum(lengths)])
            w = pc.list_flatten(lists).to_numpy(zero_copy_only=False).view(np.uint64)
            dense = {1: w}
            for k, at, h, _ in _active(w, known.value, None, longest):
                dense[k] = np.zeros(len(w), np.uint64)
                dense[k][at] = h
                yes = _has(wanted.value, h)
                h, where = np.unique(h[yes], return_index=True)
                at = at[yes][where]
                if len(h) == 0:
                    continue
                row = np.searchsorted(start, at, "right") - 1
                parts = [[dense[j][at] for j in range(1, k)], [dense[k - j][at + j] for j in range(1, k)]]
                cut = pa.array(np.arange(0, len(h) * (k - 1) + 1, k - 1, dtype=np.int32))
                lists_of = [pa.ListArray.from_arrays(cut, pa.array(np.stack(p, 1).ravel().view(np.int64))) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), t.column(0).combine_chunks().take(pa.array(row)), *lists_of],
                    ["h", "lang", "pre", "post"])

    rows = tokens.select("lang", "words").mapInArrow(run, "h long, lang string, pre array<long>, post array<long>")
    return rows.groupBy("h").agg(*[F.first(c).alias(c) for c in ("lang", "pre", "post")])


def _resolved(tokens: DataFrame, frequent: DataFrame, known, size: int, longest: int) -> DataFrame:
    """``h, a, lang, pre, post`` of all frequent phrases of two words or more.

    They are looked up in a small part of the documents, those not found there in the next
    part, and so on, so a phrase is not reported by every task; the last part holds all the rest.
    """
    spark = tokens.sparkSession
    left = frequent.where("h & 1 = 1").withColumnRenamed("n", "a")
    out = None
    for part in sorted(set(PART)):
        wanted = spark.sparkContext.broadcast(_bits(left, size))
        found = _structure(tokens.where(F.col("part") == part), known, wanted, longest)
        found = staged(left.join(found, "h"), "candidates")
        out = found if out is None else out.unionByName(found)
        left = left.join(found.select("h"), "h", "left_anti")
        if left.isEmpty():
            break
    return out


def _texts(docs: DataFrame, wanted: DataFrame, frequent, longest: int) -> DataFrame:
    """``h, phrase`` of the wanted phrases, read from the documents once more."""
    sent = docs.sparkSession.sparkContext.broadcast(_bits(wanted, _size(64 * wanted.count())))
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = utf8(b.column(0))
            langs = b.column(1).to_pylist()
            for i, j in slices(off):
                low, starts, ends, h, stop, _ = _words(buf[off[i]:off[j]], off[i:j + 1] - off[i], langs[i:j])
                w, place = _stream(h, stop)
                word = np.zeros(len(w), np.int64)
                word[place] = np.arange(len(h))
                found: dict[int, str] = {}
                for k, at, hk, _ in _active(w, frequent.value, None, longest):
                    yes = _has(sent.value, hk)
                    hk, where = np.unique(hk[yes], return_index=True)
                    for x, a in zip(hk.view(np.int64).tolist(), word[at[yes][where]].tolist()):
                        found[x] = b" ".join(low[starts[a + m]:ends[a + m]].tobytes() for m in range(k)).decode()
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.string())],
                                                     ["h", "phrase"])

    return rows.mapInArrow(run, "h long, phrase string").groupBy("h").agg(F.min("phrase").alias("phrase"))


def _scored(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """``h, lang, a, n, score, k, l, r``: every candidate (a written table) with its lowest-scoring cut."""
    cuts = candidates.select("h", "lang", "a", "n", F.posexplode(F.arrays_zip("pre", "post")).alias("k", "cut"))
    parts = cuts.select("h", "lang", "a", "n", (F.col("k") + 1).alias("k"), F.explode(F.array(
        F.struct(F.lit(True).alias("first"), F.col("cut.pre").alias("part")),
        F.struct(F.lit(False).alias("first"), F.col("cut.post").alias("part")))).alias("p")).select("*", "p.*").drop("p")
    # a common word begins or ends many phrases
    sums = (parts.groupBy("part").agg(F.count("*").alias("_w"))
            .join(frequent.select(F.col("h").alias("part"), F.col("n").alias("f")), "part"))
    cuts = by_weight(parts, sums, ["part"], "_w", parts.count()).groupBy("h", "lang", "a", "n", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}  # products pass 64 bits
    cuts = cuts.withColumn("_top", big["a"] * big["n"] * F.lit(1000).cast("decimal(4,0)"))
    cuts = cuts.withColumn("_low", big["l"] * big["r"]).withColumn("score", F.expr("_top div _low"))
    best = cuts.groupBy("h", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("h", "lang", "a", "n", "b.*")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 shards: int = SHARDS, within: int = 100) -> DataFrame:
    """Phrases of 2 to ``longest`` words whose words go together, the best ``top`` of each language ->
    ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all words of
    the language; the score is floor(1000 a n / (l r)).  A phrase is dropped if a longer one
    that holds it has at least ``within`` percent of its count; checking phrases one word
    longer is enough, because counts never rise with length.  Null texts are empty, a null
    language is ``und``; repeated rows are counted each; ties of score and count go by the
    phrase's bytes.  An empty table gives no rows.
    """
    tokens, path = _tokens(docs, shards)
    per_lang = tokens.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    words = int(per_lang.agg(F.sum("n")).first()[0] or 0)
    frequent = frequent_phrases(tokens, words, min_count, longest, shards)
    size = _size(words // 16)
    known = docs.sparkSession.sparkContext.broadcast(_bits(frequent, size))
    candidates = _resolved(tokens, frequent, known, size, longest)
    longer = candidates.where(F.size("pre") >= 2).select(
        F.explode(F.array(F.element_at("pre", -1), F.element_at("post", 1))).alias("h"), F.col("a").alias("m"))
    longer = longer.groupBy("h").agg(F.max("m").alias("m"))
    kept = candidates.join(longer, "h", "left").where(
        F.col("m").isNull() | (F.lit(100) * F.col("m") < F.lit(within) * F.col("a"))).drop("m")
    kept = staged(by_weight(kept, per_lang, ["lang"], "n", words), "kept")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    scored = _scored(kept, frequent)
    scored = staged(scored.withColumn("_r", F.rank().over(best)).where(F.col("_r") <= top).drop("_r"), "collocations")
    texts = staged(_texts(docs, scored.select("h"), known, longest), "collocation-texts")
    for t in (candidates, kept, frequent):
        drop_staged(t)
    delete_folder(docs.sparkSession, path)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.join(texts, "h").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op12(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE_SQL = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
q AS (SELECT lang, row_number() OVER () AS pid, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
w AS (SELECT lang, pid, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM q),
x AS (
  SELECT *, lead(w1, 1) OVER v AS w2, lead(w1, 2) OVER v AS w3, lead(w1, 3) OVER v AS w4, lead(w1, 4) OVER v AS w5
  FROM w WINDOW v AS (PARTITION BY pid ORDER BY i)),
g AS (
  SELECT lang, [w1] AS ws FROM x UNION ALL
  SELECT lang, [w1, w2] FROM x WHERE w2 IS NOT NULL UNION ALL
  SELECT lang, [w1, w2, w3] FROM x WHERE w3 IS NOT NULL UNION ALL
  SELECT lang, [w1, w2, w3, w4] FROM x WHERE w4 IS NOT NULL UNION ALL
  SELECT lang, [w1, w2, w3, w4, w5] FROM x WHERE w5 IS NOT NULL),
f AS (SELECT lang, ws, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
n AS (SELECT lang, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) >= 2),
u AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM c),
s AS (
  SELECT u.lang, u.ws, u.a, u.k, l.f AS l, r.f AS r, n.n, (1000 * u.a * n.n) // (l.f * r.f) AS score
  FROM u JOIN f AS l ON l.lang = u.lang AND l.ws = u.ws[1:k] JOIN f AS r ON r.lang = u.lang AND r.ws = u.ws[k + 1:]
  JOIN n ON n.lang = u.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) AS b FROM s),
i AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS i FROM c),
j AS (SELECT *, unnest(range(i + 1, len(ws) + 1)) AS j FROM i),
o AS (SELECT lang, ws[i:j] AS sub, max(a) AS m FROM j WHERE j - i + 1 < len(ws) GROUP BY ALL),
d AS (SELECT b.*, array_to_string(b.ws, ' ') AS phrase FROM b
      LEFT JOIN o ON o.lang = b.lang AND o.sub = b.ws WHERE b = 1 AND (m IS NULL OR 100 * m < 100 * a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {TOP}
"""
