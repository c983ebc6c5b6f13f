"""Cell tables kept as a replay-safe Parquet delta log.

A cell is ``(tbl, row_key, family, qualifier)``.  Writers never read old
values: they append delta rows, and readers fold the log with the family's
merge law:

* ``SUM``   - add the numbers (missing = 0);
* ``UNION`` - set union of members (one delta row per member);
* ``LAST``  - the value with the greatest order ``(epoch, seq)`` wins;
* ``SKETCH`` - union of HyperLogLog sketches (base64 text), read as an estimate of
  the number of distinct members: UNION in bounded space, for users who opt in.

Stream batches write ``tbl=<t>/batch_id=<n>`` partitions with dynamic
partition overwrite, so re-running a batch after a failure replaces its
own rows instead of adding them twice.  Administrative writes (``put``,
``put_row``, ``delete_row``) overwrite cells and go to an append-only
``batch_id=-1`` area ordered after the last committed batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from usagelake.operators.app import sketch_estimate

SUM, UNION, LAST, SKETCH = "SUM", "UNION", "LAST", "SKETCH"
LAWS = (SUM, UNION, LAST, SKETCH)

CELL = ["tbl", "row_key", "family", "qualifier"]

DELTA_SCHEMA = T.StructType([
    T.StructField("tbl", T.StringType()),
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("op", T.StringType()),      # 'add' | 'set' | 'delete'
    T.StructField("num", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("epoch", T.LongType()),     # 2*batch for stream rows, 2*batch+1 for admin rows
    T.StructField("seq", T.LongType()),
])
DELTA_COLUMNS = [f.name for f in DELTA_SCHEMA.fields]
LOG_SCHEMA = T.StructType(DELTA_SCHEMA.fields + [T.StructField("batch_id", T.LongType())])

# A bloom filter of the row keys in every row group, sized by the keys that are there.
BLOOM = {"parquet.bloom.filter.enabled#row_key": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

# The cell tables, their families and each family's merge law.
TABLE_FAMILIES = {
    "AIV": {"brand": SUM, "model": SUM, "system_version": SUM, "resolution": SUM,
            "net_status": SUM, "language": SUM, "ISP": SUM},
    "SINGLE_APP": {"click_num": SUM, "version": LAST, "day_period": SUM, "week_period": SUM,
                   "user": UNION, "duration": SUM},
    "APP_VERSION": {"click_num": SUM},
    "APP_USAGE": {"1": SUM, "2": SUM, "3": SUM, "4": SUM, "5": SUM, "6": SUM},
    "USER": {"usage_duration": LAST, "usage_statistics": LAST, "usage_history": LAST,
             "hobby": SUM, "usage_times": LAST},
    "USER_GROUP": {"usage": SUM, "hobby": SUM, "location": SUM, "period": SUM},
}


def law_of(tbl: str, family: str, families: dict | None = None) -> str:
    fams = families if families is not None else TABLE_FAMILIES.get(tbl, {})
    if family not in fams:
        raise KeyError(f"unknown family {tbl}.{family}")
    return fams[family]


def as_deltas(df: DataFrame, epoch: Column | int = 0, seq: Column | int = 0) -> DataFrame:
    """Fill the delta columns a metric did not set and order them."""
    out = df
    for c, v in (("op", F.lit("add")), ("num", F.lit(None).cast("bigint")),
                 ("text", F.lit(None).cast("string")),
                 ("epoch", epoch if isinstance(epoch, Column) else F.lit(epoch)),
                 ("seq", seq if isinstance(seq, Column) else F.lit(seq))):
        if c not in out.columns:
            out = out.withColumn(c, v)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in DELTA_SCHEMA.fields])


# ---- merge laws ----------------------------------------------------------

def _order() -> Column:
    return F.struct("epoch", "seq")


def live_rows(deltas: DataFrame, admin=True) -> DataFrame:
    """Rows that survive row deletes and cell overwrites.

    A row tombstone hides every older row of that row key; a ``set`` hides
    older rows of its cell.  ``admin`` holds the administrative rows
    (``set``/``delete``): ``True`` finds them in ``deltas``, a DataFrame
    gives them directly (the store passes its small ``batch_id=-1`` area),
    ``False`` says there are none (deltas straight from metrics), which
    leaves a plain aggregation.  Control tables are few rows per written
    cell; AQE broadcasts them when small.
    """
    if admin is False:
        return deltas.filter(F.col("op") == "add")
    ctrl = deltas.filter(F.col("op") != "add") if admin is True else admin
    o = _order()
    tombs = (ctrl.filter(F.col("op") == "delete").groupBy("tbl", "row_key")
             .agg(F.max(o).alias("_tomb")))
    sets = (ctrl.filter(F.col("op") == "set").groupBy(*CELL).agg(F.max(o).alias("_set")))
    cells = deltas.filter(F.col("op") != "delete")
    x = cells.join(tombs, ["tbl", "row_key"], "left").join(sets, CELL, "left")
    alive = F.col("_tomb").isNull() | (o > F.col("_tomb"))
    after_set = F.col("_set").isNull() | (o > F.col("_set")) | \
        ((F.col("op") == "set") & (o == F.col("_set")))
    return x.filter(alive & after_set).drop("_tomb", "_set")


def _sum(live: DataFrame) -> DataFrame:
    return live.groupBy(*CELL).agg(F.sum("num").cast("bigint").alias("value"))


def _union(live: DataFrame) -> DataFrame:
    # A set with an empty text is the empty set; an added member may be the empty text.
    member = (F.when(F.col("op") != "set", F.array("text"))
              .when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", ",")))
    return live.select(*CELL, F.explode(member).alias("member")).filter(F.col("member").isNotNull()).distinct()


def _last(live: DataFrame) -> DataFrame:
    v = F.coalesce(F.col("text"), F.col("num").cast("string"))
    return live.groupBy(*CELL).agg(F.max_by(v, _order()).alias("value"))


def _sketch(live: DataFrame) -> DataFrame:
    return live.groupBy(*CELL).agg(F.hll_union_agg(F.unbase64("text")).alias("sketch"))


def sketch_deltas(members: DataFrame, member: str = "member", lg_k: int = 12) -> DataFrame:
    """Rows ``tbl, row_key, family, qualifier`` and a member -> SKETCH deltas, one row a cell.

    Sketches are built map-side; all of a cell must have the same ``lg_k`` (2**lg_k registers;
    the relative standard error is 1.04 / sqrt(2**lg_k)).
    """
    one = members.groupBy(*CELL).agg(F.base64(F.hll_sketch_agg(F.col(member).cast("string"), F.lit(lg_k))).alias("text"))
    return as_deltas(one)


def merge_sketch(deltas: DataFrame, admin=True) -> DataFrame:
    """SKETCH law -> ``tbl, row_key, family, qualifier, value`` (estimated distinct members)."""
    return _sketch(live_rows(deltas, admin)).select(*CELL, sketch_estimate("sketch").alias("value"))


def merge_sum(deltas: DataFrame, admin=True) -> DataFrame:
    """SUM law -> ``tbl, row_key, family, qualifier, value`` (bigint)."""
    return _sum(live_rows(deltas, admin))


def merge_union(deltas: DataFrame, admin=True) -> DataFrame:
    """UNION law -> one row per member: ``tbl, row_key, family, qualifier, member``.

    A ``set`` carries a comma-joined member list (the stored text form).
    """
    return _union(live_rows(deltas, admin))


def merge_last(deltas: DataFrame, admin=True) -> DataFrame:
    """LAST law -> ``tbl, row_key, family, qualifier, value`` (text)."""
    return _last(live_rows(deltas, admin))


def merge_maps(a: DataFrame, b: DataFrame, keys, value: str = "n") -> DataFrame:
    """Sum two keyed count tables (full outer semantics, missing = 0)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return a.unionByName(b).groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


def law_table(spark: SparkSession, families: dict | None = None) -> DataFrame:
    """``tbl, family, law`` rows of the declared families (a fixed, small table)."""
    fams = families if families is not None else TABLE_FAMILIES
    rows = [(t, f, law) for t, fs in fams.items() for f, law in fs.items()]
    return spark.createDataFrame(rows, "tbl string, family string, law string")


def deltas_of_law(deltas: DataFrame, law: str, families: dict | None = None,
                  keep_deletes: bool = True) -> DataFrame:
    """Delta rows of the families governed by ``law`` (row tombstones kept)."""
    laws = law_table(deltas.sparkSession, families).filter(F.col("law") == law).drop("law")
    keep = deltas.join(F.broadcast(laws), ["tbl", "family"], "left_semi")
    if not keep_deletes:
        return keep
    return keep.unionByName(deltas.filter(F.col("op") == "delete"))


def merge_all(deltas: DataFrame, families: dict | None = None, admin=True) -> DataFrame:
    """Every cell rendered as text -> ``tbl, row_key, family, qualifier, law, value``.

    UNION cells give one row per member, SKETCH cells their estimate.
    """
    laws = law_table(deltas.sparkSession, families)
    # Tombstones carry no family, so resolve them before attaching laws.
    # The law table has one row per declared family: a fixed, small bound.
    d = live_rows(deltas, admin).join(F.broadcast(laws), ["tbl", "family"])
    # SUM and LAST cells in one aggregation (one value per cell), UNION members
    # (one row per member) and sketches in others; only laws that are declared.
    declared = {law for fams in (families if families is not None else TABLE_FAMILIES).values() for law in fams.values()}
    text = F.coalesce(F.col("text"), F.col("num").cast("string"))
    parts = []
    if declared & {SUM, LAST} or not declared:
        parts.append(d.filter(F.col("law").isin(SUM, LAST)).groupBy(*CELL, "law")
                     .agg(F.sum("num").cast("bigint").alias("_s"), F.max_by(text, _order()).alias("_l"))
                     .select(*CELL, "law", F.when(F.col("law") == SUM, F.col("_s").cast("string"))
                             .otherwise(F.col("_l")).alias("value")))
    if UNION in declared:
        u = _union(d.filter(F.col("law") == UNION).drop("law"))
        parts.append(u.select(*CELL, F.lit(UNION).alias("law"), F.col("member").alias("value")))
    if SKETCH in declared:
        s = merge_sketch(d.filter(F.col("law") == SKETCH).drop("law"), admin=False)
        parts.append(s.select(*CELL, F.lit(SKETCH).alias("law"), F.col("value").cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def _has_sketches(families: dict) -> bool:
    return any(SKETCH in laws.values() for laws in families.values())


# ---- the store -----------------------------------------------------------

class CellStore:
    """Cell tables under one shared root folder.

    Layout: ``meta/`` (declared families), ``deltas/tbl=/batch_id=/`` (log),
    ``batches/N`` (a mark for every written batch, also one without rows),
    ``snapshots/upto=N/tbl=/`` (the log folded through batch N, see
    ``compact``) and ``cuts/upto=N`` (the last administrative row in it).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.meta_path = self.root + "/meta"
        self.delta_path = self.root + "/deltas"
        self.snap_path = self.root + "/snapshots"
        self.cut_path = self.root + "/cuts"
        self.mark_path = self.root + "/batches"

    # -- file system helpers (Hadoop FS, so HDFS / object stores work too)
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _delete(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.delete(p, True) if fs.exists(p) else False

    def _children(self, path: str, files: bool = False) -> list[str]:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p) if files or st.isDirectory()]

    def discard(self, path: str) -> None:
        """Remove a folder of this store."""
        if not path.startswith(self.root + "/"):
            raise ValueError(f"{path} is not in {self.root}")
        self._delete(path)

    def committed(self, checkpoint: str) -> int:
        """Last batch that a stream checkpoint has committed, -1 when none."""
        return max([int(n) for n in self._children(checkpoint + "/commits", files=True) if n.isdigit()], default=-1)

    def latest_snapshot(self) -> int | None:
        """Largest N with a complete ``snapshots/upto=N`` (one that has ``_SUCCESS``)."""
        done = [int(n.split("=", 1)[1]) for n in self._children(self.snap_path)
                if n.startswith("upto=") and self._exists(f"{self.snap_path}/{n}/_SUCCESS")]
        return max(done) if done else None

    # -- tables
    def create_table(self, name: str, families: dict) -> bool:
        """Declare a table with ``{family: law}``; returns False if it exists."""
        path = f"{self.meta_path}/tbl={name}"
        if self._exists(path):
            print(f"table {name} already exists")
            return False
        for f, law in families.items():
            if law not in LAWS:
                raise ValueError(f"{name}.{f}: law must be one of {LAWS}")
        self._clear(name)
        rows = [(f, law) for f, law in families.items()]
        (self.spark.createDataFrame(rows, "family string, law string").coalesce(1)
         .write.mode("overwrite").parquet(path))
        return True

    def create_default_tables(self) -> None:
        for t, fams in TABLE_FAMILIES.items():
            if not self._exists(f"{self.meta_path}/tbl={t}"):
                self.create_table(t, fams)

    def drop_table(self, name: str) -> bool:
        """Remove a table's declaration, log and snapshots; returns False if absent.

        The declaration goes first: an undeclared table reads as empty, so a
        drop that stops halfway shows nothing; creating the table again
        clears what is left.
        """
        path = f"{self.meta_path}/tbl={name}"
        if not self._exists(path):
            print(f"table {name} does not exist")
            return False
        self._delete(path)
        self._clear(name)
        return True

    def _clear(self, name: str) -> None:
        self._delete(f"{self.delta_path}/tbl={name}")
        for snap in self._children(self.snap_path):
            self._delete(f"{self.snap_path}/{snap}/tbl={name}")

    def declared(self, deltas: DataFrame) -> DataFrame:
        """Delta rows of declared tables."""
        return deltas.filter(F.col("tbl").isin(sorted(self.families())))

    def families(self) -> dict:
        """``{table: {family: law}}`` of declared tables (a few rows)."""
        if not self._children(self.meta_path):
            return {}
        out: dict = {}
        for r in self.spark.read.parquet(self.meta_path).collect():
            out.setdefault(r["tbl"], {})[r["family"]] = r["law"]
        return out

    # -- the log
    def deltas(self, tbl: str | None = None) -> DataFrame:
        """Rows of the log; a batch shows once it is marked, so one that a failure cut short does not."""
        if not self._exists(self.delta_path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        d = self.spark.read.schema(LOG_SCHEMA).parquet(self.delta_path).filter(F.col("batch_id") <= self.last_batch())
        if tbl is not None:
            d = d.filter(F.col("tbl") == tbl)  # partition pruning on tbl=
        return d

    def _snapshot(self, n: int) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.snap_path}/upto={n}")

    def _cut(self, n: int) -> tuple[int, int]:
        """Order of the last administrative row that snapshot ``n`` holds."""
        r = self.spark.read.schema("epoch long, seq long").parquet(f"{self.cut_path}/upto={n}").first()
        return r["epoch"], r["seq"]

    def log(self, tbl: str | None = None) -> DataFrame:
        """The rows a reader folds: latest snapshot plus everything after it.

        Without a snapshot this is the whole delta log.  With ``upto=N`` it is
        the snapshot, stream batches after N, and the administrative rows that
        come after the last one folded into the snapshot, whenever they were
        written; partition pruning on ``batch_id`` skips the rest.
        """
        d = self.deltas(tbl)
        n = self.latest_snapshot()
        if n is None:
            return d
        snap = self._snapshot(n)
        if tbl is not None:
            snap = snap.filter(F.col("tbl") == tbl)
        newer = d.filter(F.col("batch_id") > n).unionByName(self._after(d.filter(F.col("batch_id") == -1), n))
        return snap.unionByName(newer)

    def _after(self, admin: DataFrame, n: int) -> DataFrame:
        """Administrative rows that snapshot ``n`` does not hold."""
        epoch, seq = self._cut(n)
        return admin.filter((F.col("epoch") > epoch) | ((F.col("epoch") == epoch) & (F.col("seq") > seq)))

    def _next_order(self) -> tuple[int, int]:
        """Order of the next administrative row: after the last batch and after all rows before it.

        A stored counter, not a clock: the largest number of the rows and of the
        latest cut, plus one.  One writer at a time makes administrative writes.
        """
        n = self.latest_snapshot()
        last = self._cut(n)[1] if n is not None else -1
        stored = self.deltas().filter(F.col("batch_id") == -1).agg(F.max("seq")).first()[0]
        return 2 * self.last_batch() + 1, max(last, -1 if stored is None else stored) + 1

    def compact(self, upto: int | None = None) -> int:
        """Fold the log through batch ``upto`` (default: the last batch) into a snapshot.

        SUM cells become one row with the total, UNION cells one row per
        member, LAST cells the winning row with its order, SKETCH cells one
        sketch; tombstones and
        overwrites at or before the point are applied and dropped.  The
        snapshot is written to ``snapshots/upto=N`` by table, sorted by row
        key; readers only use it once its ``_SUCCESS`` marker exists, so a
        failed compaction changes nothing.  A finished snapshot is never
        written again: later administrative rows wait for the next one.
        Returns N.  Old ``deltas`` partitions are left in place (readers skip
        them); remove them with ``purge`` once no reader needs older points.
        """
        n = self.last_batch() if upto is None else int(upto)
        prev = self.latest_snapshot()
        if prev is not None and n < prev:
            raise ValueError(f"a snapshot through batch {prev} already exists")
        if prev == n:
            return n
        d = self.log().filter(((F.col("batch_id") >= 0) & (F.col("batch_id") <= n)) |
                              ((F.col("batch_id") == -1) & (F.col("epoch") <= 2 * n + 1)))
        control = self._control(d)
        cut = control.agg(F.max(F.struct("epoch", "seq")).alias("m")).first()["m"] if control else None
        live = live_rows(d.drop("batch_id"), admin=control if cut else False)
        cut = tuple(cut) if cut else (self._cut(prev) if prev is not None else (-1, -1))
        self.spark.createDataFrame([cut], "epoch long, seq long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.cut_path}/upto={n}")
        families = self.families()
        laws = law_table(self.spark, families)
        x = live.join(F.broadcast(laws), ["tbl", "family"])
        o = _order()
        # SUM and LAST cells in one aggregation, UNION members in another.
        is_sum = F.col("law") == SUM
        one = (x.filter(F.col("law").isin(SUM, LAST)).groupBy(*CELL, "law")
               .agg(F.sum("num").cast("bigint").alias("_s"),
                    F.max_by(F.struct("num", "text", "epoch", "seq"), o).alias("w"))
               .select(*CELL,
                       F.when(is_sum, F.col("_s")).otherwise(F.col("w.num")).alias("num"),
                       F.when(is_sum, F.lit(None).cast("string")).otherwise(F.col("w.text")).alias("text"),
                       F.when(is_sum, F.lit(2 * n).cast("bigint")).otherwise(F.col("w.epoch")).alias("epoch"),
                       F.when(is_sum, F.lit(0).cast("bigint")).otherwise(F.col("w.seq")).alias("seq")))
        unions = (_union(x.filter(F.col("law") == UNION).drop("law"))
                  .select(*CELL, F.lit(None).cast("bigint").alias("num"), F.col("member").alias("text"),
                          F.lit(2 * n).cast("bigint").alias("epoch"), F.lit(0).cast("bigint").alias("seq")))
        folded = one.unionByName(unions)
        if _has_sketches(families):
            sketches = _sketch(x.filter(F.col("law") == SKETCH).drop("law"))
            folded = folded.unionByName(sketches.select(
                *CELL, F.lit(None).cast("bigint").alias("num"), F.base64("sketch").alias("text"),
                F.lit(2 * n).cast("bigint").alias("epoch"), F.lit(0).cast("bigint").alias("seq")))
        snap = (folded
                .withColumn("op", F.lit("add")).withColumn("batch_id", F.lit(n).cast("bigint"))
                .select(*[f.name for f in LOG_SCHEMA.fields]))
        (snap.repartitionByRange("tbl", "row_key").sortWithinPartitions("tbl", "row_key")
         .write.mode("overwrite").options(**BLOOM).option("partitionOverwriteMode", "static").partitionBy("tbl")
         .parquet(f"{self.snap_path}/upto={n}"))
        return n

    def purge(self, upto: int) -> None:
        """Delete what snapshot ``upto`` (which must exist) made needless.

        Stream partitions folded into it, snapshots before the latest one, and
        administrative rows once all of a table's are folded.
        """
        latest = self.latest_snapshot()
        if latest is None or latest < upto:
            raise RuntimeError(f"no complete snapshot through batch {upto}")
        for path in (self.snap_path, self.cut_path):
            for name in self._children(path):
                if name.startswith("upto=") and int(name.split("=", 1)[1]) < latest:
                    self._delete(f"{path}/{name}")
        waiting = self._after(self.deltas().filter(F.col("batch_id") == -1), latest)
        waiting = {r["tbl"] for r in waiting.select("tbl").distinct().collect()}  # declared tables: a few
        for t in self._children(self.delta_path):
            for b in self._children(f"{self.delta_path}/{t}"):
                if not b.startswith("batch_id="):
                    continue
                n = int(b.split("=", 1)[1])
                if 0 <= n <= upto or (n == -1 and t.removeprefix("tbl=") not in waiting):
                    self._delete(f"{self.delta_path}/{t}/{b}")
        for n in self._children(self.mark_path, files=True):
            if n.isdigit() and int(n) < upto:
                self._delete(f"{self.mark_path}/{n}")

    def last_batch(self) -> int:
        """Largest committed stream batch id, -1 when none.

        Read from the marks of the batches (one listing, no scan) and the
        latest snapshot, so it stays right after ``purge``.
        """
        ids = [int(n) for n in self._children(self.mark_path, files=True) if n.isdigit()]
        snap = self.latest_snapshot()
        return max([-1, *ids] + ([snap] if snap is not None else []))

    def write_batch(self, deltas: DataFrame, batch_id: int) -> None:
        """Write one stream batch; re-running the same batch replaces its rows.

        ``rebalance`` makes files of the advised partition size per table:
        small tables get one file a batch, a large one is split.
        """
        # The writer owns the order: every row of batch n sorts after batch n-1.
        out = (as_deltas(deltas).withColumn("epoch", F.lit(2 * batch_id).cast("bigint"))
               .withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        (out.hint("rebalance", "tbl").write.mode("overwrite").options(**BLOOM).option("partitionOverwriteMode", "dynamic")
         .partitionBy("tbl", "batch_id").parquet(self.delta_path))
        fs, p = self._fs(f"{self.mark_path}/{batch_id}")
        fs.create(p, True).close()

    def _admin(self, rows: list) -> None:
        epoch, base = self._next_order()
        data = [(t, r, f, q, op, n, x, epoch, base + i, -1) for i, (t, r, f, q, op, n, x) in enumerate(rows)]
        df = self.spark.createDataFrame(data, LOG_SCHEMA)
        df.write.mode("append").partitionBy("tbl", "batch_id").parquet(self.delta_path)

    def _law(self, tbl: str, family: str) -> str:
        return law_of(tbl, family, self.families().get(tbl, {}))

    def put(self, tbl: str, row_key: str, family: str, qualifier: str, value) -> None:
        """Overwrite one cell (numbers for SUM, comma list for UNION, text for LAST)."""
        self.put_row(tbl, row_key, family, {qualifier: value})

    def put_row(self, tbl: str, row_key: str, family: str, values: dict) -> None:
        """Overwrite several qualifiers of one family of one row."""
        law = self._law(tbl, family)
        if law == SKETCH:
            raise ValueError(f"{tbl}.{family} is a SKETCH family; add sketches with write_batch()")
        rows = []
        for q, v in values.items():
            if law == SUM:
                rows.append((tbl, row_key, family, str(q), "set", int(v), None))
            else:
                rows.append((tbl, row_key, family, str(q), "set", None, str(v)))
        self._admin(rows)

    def put_frame(self, tbl: str, cells: DataFrame) -> None:
        """Overwrite many cells from ``row_key, family, qualifier, value`` (value as text), in one write.

        Rows of undeclared families and of SKETCH families are refused; of several rows for one cell
        the one with the greatest value text counts.
        """
        laws = {f: law for f, law in self.families().get(tbl, {}).items() if law != SKETCH}
        unknown = cells.filter(~F.col("family").isin(sorted(laws))).select("family").first()
        if unknown is not None:
            raise KeyError(f"unknown family {tbl}.{unknown['family']}")
        sums = [f for f, law in laws.items() if law == SUM]
        one = cells.groupBy("row_key", "family", "qualifier").agg(F.max("value").alias("value"))
        is_sum = F.col("family").isin(sums) if sums else F.lit(False)
        epoch, seq = self._next_order()
        out = one.select(
            F.lit(tbl).alias("tbl"), F.col("row_key").cast("string"), "family", F.col("qualifier").cast("string"),
            F.lit("set").alias("op"), F.when(is_sum, F.col("value").cast("bigint")).alias("num"),
            F.when(~is_sum, F.col("value").cast("string")).alias("text"),
            F.lit(epoch).cast("bigint").alias("epoch"), F.lit(seq).cast("bigint").alias("seq"), F.lit(-1).cast("bigint").alias("batch_id"))
        out.write.mode("append").partitionBy("tbl", "batch_id").parquet(self.delta_path)

    def delete_row(self, tbl: str, row_key: str) -> None:
        """Delete every cell of a row (a tombstone; later writes show again)."""
        self._admin([(tbl, row_key, None, None, "delete", None, None)])

    # -- reads
    def scan(self, tbl: str) -> DataFrame:
        """Every cell of a table as text -> ``row_key, family, qualifier, law, value``.

        An undeclared table is empty.
        """
        fams = {tbl: self.families().get(tbl, {})}
        d = self.log(tbl)
        m = merge_all(d.drop("batch_id"), fams, admin=self._control(d, tbl))
        return m.drop("tbl")

    def _control(self, d: DataFrame, tbl: str | None = None) -> DataFrame | bool:
        """Administrative rows of ``d``, or False where there are none: then nothing can hide a row, and no join is needed.

        They live only in ``batch_id=-1``: one listing tells whether there are any,
        and partition pruning keeps the control tables from scanning the stream log.
        """
        tables = self._children(self.delta_path) if tbl is None else [f"tbl={tbl}"]
        if not any(self._exists(f"{self.delta_path}/{t}/batch_id=-1") for t in tables):
            return False
        return d.filter(F.col("batch_id") == -1).drop("batch_id")

    def get(self, tbl: str, row_key: str, family: str | None = None) -> DataFrame:
        """Cells of one row (optionally one family); an absent row is empty.

        Snapshots are sorted by row key, so their scan skips all but one stretch;
        files of the log carry a bloom filter of their row keys, so those without
        the row are skipped.
        """
        d = self.log(tbl).filter(F.col("row_key") == row_key)
        fams = self.families().get(tbl, {})
        if family is not None:
            d = d.filter(F.col("family").isNull() | (F.col("family") == family))
            fams = {family: fams[family]} if family in fams else {}
        return merge_all(d.drop("batch_id"), {tbl: fams}, admin=self._control(d, tbl)).drop("tbl")

    def get_family_map(self, tbl: str, row_key: str, family: str) -> DataFrame:
        """One row holding the family as a ``qualifier -> value`` map.

        For SUM and LAST families (one value per qualifier) whose qualifiers
        are few enough for one value.  UNION members grow with the data;
        read them as rows with ``get`` instead.
        """
        if self._law(tbl, family) == UNION:
            raise ValueError(f"{tbl}.{family} is a UNION family; read its members with get()")
        g = self.get(tbl, row_key, family)
        return g.agg(F.map_from_entries(F.collect_list(F.struct("qualifier", "value"))).alias(family))
