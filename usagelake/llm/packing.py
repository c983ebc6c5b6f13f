"""Best-fit packing: documents to fixed-length sequences by a grouping genetic algorithm.

Documents are tokenised; only those longer than a sequence are cut.  Pieces of
full length are sequences by themselves.  The others are dealt at random into
blocks of bounded size; several islands evolve a packing of each block.  A
chromosome is a set of bins.  Crossover injects whole well-filled bins of one
parent into the other, drops the bins there that repeat a document, and best-fits
the displaced documents.  Between epochs the elite of every island of a block
migrates to the block's other islands.  Bins that stay poorly filled are
dissolved at the end and their documents packed again in shared blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from usagelake.llm.common import arrow_limits, merged, slices, staged, utf8
from usagelake.llm.words import SPACE, hash_spans

LENGTH = 1024
END_ID = 2
BLOCK = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4
WELL_FILLED = 0.97

# Texts of these characters (new line, printable ASCII, Latin letters and signs) and
# of words of moderate length split alike in both encoders of the vocabulary, and
# the one over its rank file is faster; all other texts go through the tokenizer
# file itself.
_PLAIN = re.compile(rb"(?:[\n\x20-\x7e]++|\xc2[\xa1-\xac\xae-\xbf]|[\xc3-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])*+\Z")
_SPECIAL = b"<|endoftext|>"
_LONG_RUN = 400
ENCODE_BYTES = 1 << 22  # text encoded at a time: the longer, the fewer parts are new, and the more memory


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids of the tokenizer file, special strings included, without added special tokens.

    A plain text's tokens never cross the place before a space that a non-space follows,
    so texts are cut there and every different part is encoded once in a batch of
    texts; parts are told apart by 64-bit hashes.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self.path = path
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                          special_tokens={})
            self.size = np.zeros(max(merges.values()) + 1, np.int64)
            for raw, k in merges.items():
                self.size[k] = len(raw)

    @cached_property
    def full(self):
        """The tokenizer file's own encoder, read when a text needs it."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def texts(self, buf: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of every text of a buffer."""
        data, n = buf.tobytes(), len(off) - 1
        plain = np.zeros(n, bool)
        if self.fast:
            wide = long_runs(buf, off)
            for k in range(n):
                raw = data[off[k]:off[k + 1]]
                plain[k] = k not in wide and _PLAIN.match(raw) is not None and _SPECIAL not in raw
        ids, cut = self._parts(buf, off, data, plain) if plain.any() else (None, None)
        for k in range(n):
            if plain[k]:
                yield ids[cut[k]:cut[k + 1]]
            else:
                text = data[off[k]:off[k + 1]].decode("utf-8", "replace")
                yield np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)

    def _parts(self, buf: np.ndarray, off: np.ndarray, data: bytes, plain: np.ndarray):
        """Ids of all plain texts in one array, and where each text's begin."""
        head = np.zeros(len(buf) + 1, bool)
        head[:-2] = (buf[:-1] == 32) & (buf[1:] != 32) & (buf[1:] != 10) if len(buf) else False
        head[off[1:-1] - 1] = False
        head[off] = True
        starts = np.flatnonzero(head)
        first = np.searchsorted(starts, off)  # of every text, among the parts
        starts, ends = starts[:-1], starts[1:]
        count = np.diff(first)
        if not plain.all():
            use = np.repeat(plain, count)
            starts, ends, count = starts[use], ends[use], np.where(plain, count, 0)
        coded = pa.array(hash_spans(buf, starts, ends).view(np.int64)).dictionary_encode()
        which = coded.indices.to_numpy()
        at = np.empty(len(coded.dictionary), np.int64)
        at[which[::-1]] = np.arange(len(which))[::-1]
        ids, first = self._encoded([data[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())])
        taken = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids)).take(coded.indices)
        return taken.flatten().to_numpy(), taken.offsets.to_numpy()[np.concatenate(([0], np.cumsum(count)))]

    def _encoded(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different parts in one array and the place of each one's first.

        Parts that begin with a space are encoded as one text and cut by the tokens' bytes.
        """
        spaced = np.array([p[0] == 32 for p in parts], bool)
        joined = np.array(self.fast.encode_ordinary(b"".join([p for p in parts if p[0] == 32]).decode()), np.uint32)
        ends = np.cumsum([len(p) for p in parts if p[0] == 32])
        count = np.zeros(len(parts), np.int64)
        count[spaced] = np.diff(np.searchsorted(np.cumsum(self.size[joined]), ends) + 1, prepend=0)
        heads = [self.fast.encode_ordinary(p.decode()) for p in parts if p[0] != 32]  # texts' first parts
        count[~spaced] = [len(h) for h in heads]
        first = np.concatenate(([0], np.cumsum(count)))
        ids = np.empty(first[-1], np.uint32)
        from_head = np.repeat(~spaced, count)
        ids[~from_head] = joined
        ids[from_head] = np.fromiter((i for h in heads for i in h), np.uint32)
        return ids, first


def long_runs(buf: np.ndarray, off: np.ndarray) -> set[int]:
    """Rows with more than _LONG_RUN bytes between white space."""
    spaces = np.flatnonzero(SPACE[buf])
    if len(buf) and np.diff(spaces, prepend=-1, append=len(buf)).max() <= _LONG_RUN:
        return set()
    breaks = np.sort(np.concatenate((spaces, off)), kind="stable")
    wide = breaks[:-1][np.diff(breaks) > _LONG_RUN]
    return set((np.searchsorted(off, wide, "right") - 1).tolist())


def pieces(docs: DataFrame, path: str, ranks: str | None = None, length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's pieces.

    ``path`` and ``ranks`` are files that every executor has.  A document's ids end
    with END_ID; a longer one is cut into full pieces after a first, shorter rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, ranks)
        for b in merged(batches, ENCODE_BYTES):
            buf, off = utf8(b.column(1))
            keys, rows = b.column(0).to_pylist(), []
            for i, j in slices(off, ENCODE_BYTES):
                for key, ids in zip(keys[i:j], encoder.texts(buf[off[i]:off[j]], off[i:j + 1] - off[i])):
                    n = len(ids) + 1
                    raw = ids.astype("<u4", copy=False).tobytes() + END_ID.to_bytes(4, "little")
                    cuts = [0, *range(n % length or length, n + 1, length)]
                    rows += [(key, k, s, e - s, zlib.crc32(raw[4 * s:4 * e]))
                             for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:]))]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in cols[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    arrow_limits(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------- grouping genetic algorithm
def best_fit(bins: list[list[int]], fill: list[int], items, sizes, length: int) -> None:
    """Put each item into the fullest bin that holds it, or a new one (in place)."""
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    mask = 0
    for b, f in enumerate(fill):
        by_room[length - f].append(b)
        mask |= 1 << (length - f)
    for i in items:
        s = sizes[i]
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
            fill[b] += s
        else:
            b = len(bins)
            bins.append([i])
            fill.append(s)
        room = length - fill[b]
        by_room[room].append(b)
        mask |= 1 << room


def cost(fill: list[int], length: int) -> tuple:
    """Fewer bins first, then bins as unequally filled as possible."""
    f = np.asarray(fill, float) / length
    return len(fill), -float((f * f).sum())


def crossover(a, b, sizes, length: int, rng) -> tuple[list[list[int]], list[int]]:
    """Inject a random part of ``b``'s well-filled bins into ``a``."""
    bins_b, fill_b = b
    good = [k for k, f in enumerate(fill_b) if f >= WELL_FILLED * length] or list(range(len(fill_b)))
    take = [k for k in good if rng.random() < 0.5]
    new = [list(bins_b[k]) for k in take]
    fill = [fill_b[k] for k in take]
    used = bytearray(len(sizes))
    for group in new:
        for i in group:
            used[i] = 1
    displaced = []
    for group, f in zip(*a):
        if any([used[i] for i in group]):
            displaced += [i for i in group if not used[i]]
        else:
            new.append(list(group))
            fill.append(f)
    # mutation: the emptiest bins give their documents up as well
    order = np.argsort(fill)[:2].tolist()
    for k in sorted(order, reverse=True):
        displaced += new.pop(k)
        fill.pop(k)
    displaced.sort(key=lambda i: -sizes[i])
    best_fit(new, fill, displaced, sizes, length)
    return new, fill


def evolve(sizes: list[int], length: int, seeds: list[np.ndarray], rng) -> np.ndarray:
    """Bin number of every item after GENERATIONS generations from ``seeds`` and fresh solutions."""
    people = []
    for number in seeds:
        bins = [[] for _ in range(int(number.max()) + 1)]
        for i, k in enumerate(number):
            bins[k].append(i)
        people.append((bins, [sum(sizes[i] for i in g) for g in bins]))
    size = np.asarray(sizes)
    while len(people) < POPULATION:
        noise = 1 + (0 if not people else 0.15) * rng.random(len(sizes))
        bins, fill = [], []
        best_fit(bins, fill, np.argsort(-size * noise, kind="stable").tolist(), sizes, length)
        people.append((bins, fill))
    floor = -(-int(size.sum()) // length)
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: cost(p[1], length))
        if len(people[0][1]) <= floor:
            break
        i, j = rng.permutation(min(3, len(people)))[:2]
        people[-1] = crossover(people[i], people[j], sizes, length, rng)
        people[-2] = crossover(people[0], people[-2], sizes, length, rng)
    bins, _ = min(people, key=lambda p: cost(p[1], length))
    out = np.empty(len(sizes), np.int64)
    for k, group in enumerate(bins):
        out[group] = k
    return out


def _island(length: int, epoch: int, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row"], ignore_index=True)
        island, block = int(group["island"].iloc[0]), int(group["block"].iloc[0])
        rng = np.random.default_rng((seed, epoch, island, block))
        elites = []
        if group["elite"].iloc[0] is not None:
            table = np.stack(group["elite"].to_list())
            elites = [table[:, k] for k in range(table.shape[1])]
        bins = evolve(group["length"].tolist(), length, elites, rng)
        fill = np.bincount(bins, weights=group["length"])
        n, spread = cost(fill.tolist(), length)
        return group.assign(bin=bins, filled=fill[bins].astype(np.int64), n_bins=n, spread=spread).drop(
            columns="elite")
    return run


_OUT = "row long, length long, block long, island int, bin long, filled long, n_bins long, spread double"


def pack(items: DataFrame, length: int = LENGTH, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """``row, length`` (1 to ``length``) -> ``row, sequence, filled``: a packing of all rows.

    ``row`` must be unique.  A block holds about ``block`` rows whatever the input's
    size, so a task's work and memory are bounded.
    """
    n = items.count()
    blocks = max(1, -(-n // block))
    state = items.withColumn("block", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(blocks))).withColumn(
        "elite", F.lit(None).cast("array<long>"))
    for epoch in range(EPOCHS):
        people = state.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
        done = staged(people.groupBy("block", "island").applyInPandas(_island(length, epoch, seed), _OUT), "islands")
        if epoch + 1 < EPOCHS:  # migration: every island of the block starts from all elites
            state = done.groupBy("row", "length", "block").agg(
                F.sort_array(F.collect_list(F.struct("island", "bin"))).getField("bin").alias("elite"))
    best = done.groupBy("block").agg(F.min(F.struct("n_bins", "spread", "island")).alias("best"))
    return done.join(best, "block").where("island = best.island").select(
        "row", "length", (F.col("block") * (1 << 20) + F.col("bin")).alias("sequence"), "filled")


def packed(docs: DataFrame, path: str, ranks: str | None = None, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Null and empty texts are documents of END_ID alone; repeated rows are packed
    each; an empty table gives no rows; extra columns are ignored.
    """
    cut = pieces(docs, path, ranks, length)
    cut = staged(cut, "pieces")
    rows = staged(cut.withColumn("row", F.monotonically_increasing_id()), "rows")
    full = rows.where(F.col("length") == length)
    part = rows.where(F.col("length") < length)
    first = staged(pack(part.select("row", "length"), length), "packing")
    kept = first.where(F.col("filled") >= WELL_FILLED * length).select("row", F.col("sequence") * 2)
    again = pack(first.where(F.col("filled") < WELL_FILLED * length).select("row", "length"), length, seed=11)
    placed = kept.unionAll(again.select("row", F.col("sequence") * 2 + 1)).toDF("row", "sequence_id")
    placed = part.join(placed, "row").unionByName(full.withColumn("sequence_id", -1 - F.col("row")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"]
    # a sequence holds at most `length` pieces: its list is bounded
    held = placed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("row", *columns[:-1]))).alias("p"))
    offsets = F.expr("transform(p, (x, i) -> struct(x.doc_id as doc_id, x.piece as piece, x.start as start, "
                     "x.length as length, x.ids_crc32 as ids_crc32, "
                     "aggregate(slice(p, 1, i), 0L, (s, y) -> s + y.length) as offset))")
    return held.select("sequence_id", F.explode(offsets).alias("x")).select(
        "x.doc_id", "x.piece", "x.start", "x.length", "x.ids_crc32", "sequence_id", "x.offset")


def op8(docs: DataFrame) -> DataFrame:
    return packed(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
