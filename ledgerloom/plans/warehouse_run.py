"""Run order of the warehouse: stage → initial load → clean-up → incremental
load → period correction → mart.

Every step's output is written once as a Parquet snapshot under the cluster's
``spark.checkpoint.dir`` and read back by the next step. That cuts lineage (a
lost executor costs one step, not the whole chain), gives the surrogate keys a
fixed value, and follows the snapshot-flip rule: a step never overwrites a
path that its own plan reads. Snapshot folders are keyed by the input files
(listed recursively, on every call) and the code version, so a changed input
or operator never reuses stale data. A table is written to a private folder
and published by a rename, so concurrent builders cannot mix their files.
"""

from __future__ import annotations

import contextvars
import datetime as dt
import hashlib
import pathlib
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import audit, keys, mart, upkeep
from ledgerloom.operators import warehouse as wh
from ledgerloom.plans import fixtures
from ledgerloom.schemas import AUDIT_LOG
from ledgerloom.session import ensure_checkpoint_dir, keep_writers_open, size_broadcasts, size_shuffles
from ledgerloom.sources.tables import table_path

# Fixed values of the period correction scenario.
CORRECTION = wh.Correction(start=dt.date(2000, 1, 1), end=dt.date(2000, 12, 31),
                           prefix="ORD-1", keep_percent=20)
INPUT_TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]
TABLES = ("customers", "addresses", "products", "orders", "order_details")
STEP_METHODS = {"initial": "initial", "cleanup": "cleaned", "secondary": "secondary",
                "correction": "corrected"}

# Sub-folder of the checkpoint folder that holds the snapshots (a benchmark
# points it at a fresh folder to measure a cold build).
NAMESPACE = "ledgerloom-snapshots"

MIN_BUCKETS = 16

_RUNS: dict[tuple[str, str, str, str], "WarehouseRun"] = {}
_RUNS_LOCK = threading.Lock()


def _code_version() -> str:
    root = pathlib.Path(__file__).resolve().parents[1]
    h = hashlib.sha1()
    for p in sorted(root.rglob("*.py")):
        h.update(p.read_bytes())
    return h.hexdigest()[:12]


def input_state(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """A name of the input files (path, length, time; folders recursively) and the code, and the files' bytes."""
    h, size = hashlib.sha1(_code_version().encode()), 0
    conf = spark._jsc.hadoopConfiguration()
    for t in INPUT_TABLES:
        p = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, t))
        found, files = [], p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            st = files.next()
            size += st.getLen()
            found.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
        h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:16], size


def input_digest(spark: SparkSession, sf_dir: str) -> str:
    return input_state(spark, sf_dir)[0]


class WarehouseRun:
    """The warehouse built from one folder of input tables, step by step, as snapshots."""
    def __init__(self, spark: SparkSession, sf_dir: str, digest: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        keep_writers_open(spark)
        # Buckets of customers and addresses: as many as the session's shuffles have
        # partitions, the number that its user sizes to the data.
        self.buckets = buckets or max(MIN_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{base}/{NAMESPACE}/{digest or input_digest(spark, sf_dir)}-{self.buckets}"
        self._rows: dict[str, int] = {}
        self._memo: dict[str, object] = {}
        self._parts: dict[str, dict[str, list[str]]] = {}
        self._locks: dict[str, threading.RLock] = {}
        self._locks_guard = threading.Lock()

    # -- snapshot plumbing -------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(f"{path}/_SUCCESS")
        return fs.exists(p)

    def snapshot(self, name: str, build, partition_by: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        if not self._exists(path):
            self._publish(build(), path, partition_by)
        return self.spark.read.parquet(path)

    def _publish(self, df: DataFrame, path: str, partition_by: str | None = None) -> None:
        """Write to a private folder, then rename; of concurrent builders the
        first to finish wins and the others drop their copy."""
        own = f"{self.root}/_building/{uuid.uuid4().hex}"
        seen = Observation()                       # the write counts its own rows
        w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**keys.KEPT)
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(own)
        self._rows[path] = seen.get["rows"]
        fs, target = self._fs(path)
        _, source = self._fs(own)
        fs.mkdirs(target.getParent())
        if fs.exists(target) and not self._exists(path):
            fs.delete(target, True)     # left by something that died; a published folder is whole
        if not fs.exists(target) and fs.rename(source, target):
            # A builder that renamed in between: ours then lies inside its folder.
            _, inner = self._fs(f"{path}/{source.getName()}")
            if fs.exists(inner):
                fs.delete(inner, True)
        else:
            fs.delete(source, True)
            if not self._exists(path):
                raise OSError(f"{path} could not be published")

    # The store that loads write through (see ``upkeep.Store``).
    def write(self, name: str, build, partition_by: str | None = None) -> str:
        path = f"{self.root}/{name}"
        if not self._exists(path):
            self._publish(build(), path, partition_by)
        return path

    def rows(self, path: str) -> int:
        """Rows of a published folder: counted by the write, else taken from the files' footers."""
        if path not in self._rows:
            self._rows[path] = self.spark.read.parquet(path).count()
        return self._rows[path]

    def folders(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return upkeep.partition_folders(path, [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()])

    def _memoized(self, key: str, make):
        # One builder per step even when queries run on several threads; a
        # lock per step, so independent steps still build side by side (steps
        # only wait on earlier steps, so locks are taken in one order).
        with self._locks_guard:
            lock = self._locks.setdefault(key, threading.RLock())
        with lock:
            if key not in self._memo:
                self._memo[key] = make()
            return self._memo[key]

    def parts(self, step: str) -> dict[str, list[str]]:
        """Part folders of every table after ``step`` (materialising it)."""
        getattr(self, STEP_METHODS[step])()
        return {t: list(p) for t, p in self._parts[step].items()}

    def read_parts(self, paths: list[str]) -> DataFrame:
        return self.spark.read.parquet(*paths)

    def _core(self, step: str) -> wh.CoreState:
        return wh.CoreState(**{t: upkeep.read(self.spark, t, self._parts[step][t]) for t in TABLES})

    def _write_all(self, todo) -> None:
        """Write independent snapshot folders concurrently (one Spark job per
        thread); folders that already exist are skipped."""
        missing = [(p, b) for p, b in todo if not self._exists(p)]
        if not missing:
            return
        frames = [(p, b()) for p, b in missing]     # plans are built on this thread
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            list(pool.map(lambda pf: self._publish(pf[1], pf[0]), frames))

    def _drop_staging(self, owner: str) -> None:
        """Delete the key-staging folders written while building a step: the
        step's snapshots are written, so nothing reads them any more."""
        for path in keys.staged_by(owner):
            fs, p = self._fs(path)
            fs.delete(p, True)

    @staticmethod
    def _submit(pool: ThreadPoolExecutor, fn, *args):
        # Worker threads inherit the caller's context (the staging scope).
        return pool.submit(contextvars.copy_context().run, fn, *args)

    # -- steps ---------------------------------------------------------------
    def stage_lines(self) -> str:
        """All flat lines, derived once from the tables and written partitioned
        by stage batch, without the columns that others give; returns the folder."""
        def make():
            self.snapshot("stage/lines", lambda: fixtures.tagged_lines(self.spark, self.sf_dir),
                          partition_by="stage_part")
            return f"{self.root}/stage/lines"
        return self._memoized("lines", make)

    def raw_orders(self) -> DataFrame:
        """The initial batch: the ``initial`` folder of the line snapshot."""
        return self._memoized("raw", lambda: fixtures.full_lines(self.spark.read.parquet(
            f"{self.stage_lines()}/stage_part=initial")))

    def new_lines(self) -> DataFrame:
        """Lines that first arrive in the delta: the ``delta`` folder of the line snapshot."""
        return fixtures.full_lines(self.spark.read.parquet(f"{self.stage_lines()}/stage_part=delta"))

    def delta_orders(self) -> DataFrame:
        def build():
            return fixtures.delta_orders(self.spark, self.sf_dir, self.raw_orders(), self.new_lines())
        return self._memoized("delta", lambda: self.snapshot("stage/delta_orders", build))

    def initial(self) -> wh.CoreState:
        return self._memoized("initial", self._build_initial)

    def _table(self, step: str, t: str, build) -> DataFrame:
        """Write one table of a step as soon as it is built and hand dependents
        the written copy, so no later statement re-runs its plan."""
        if t in upkeep.BUCKET_KEYS:
            paths = upkeep.write_buckets(self, f"{step}/{t}", t, build)
        elif t in upkeep.BY_YEAR:
            paths = upkeep.write_years(self, f"{step}/{t}", build)
        else:
            paths = [self.write(f"{step}/{t}", build)]
        self._parts.setdefault(step, {})[t] = paths
        return upkeep.read(self.spark, t, paths)

    def _log_of(self, *states: str) -> DataFrame | None:
        paths = [p for p in (f"{self.root}/audit/{s}" for s in states) if self._exists(p)]
        return upkeep.read(self.spark, "load_audit", paths) if paths else None

    def _open_load(self, name: str, load_type: str, source: str, *earlier: str) -> int:
        """Note a load as started, under the id after the kept log's last; returns the id."""
        self.write(f"audit/{name}-started", lambda: audit.with_times(audit.audit_started(
            self.spark, audit.next_load_id(self._log_of(*earlier)), load_type, source), ended=False))
        return self._log_of(f"{name}-started").first()["load_id"]

    def _build_initial(self) -> wh.CoreState:
        """``wh.initial_load`` statement by statement, independent tables built
        concurrently: products alongside customers → addresses ∥ (orders → lines)."""
        raw = self.raw_orders()
        step = "initial"
        load_id = self._open_load("initial", "INITIAL", "stage.raw_orders")
        with keys.staging_scope() as owner, ThreadPoolExecutor(max_workers=3) as pool:
            fc = self._submit(pool, self._table, step, "customers",
                              lambda: wh.initial_customers(raw))
            fp = self._submit(pool, self._table, step, "products",
                              lambda: wh.initial_products(raw))
            customers = fc.result()
            fa = self._submit(pool, self._table, step, "addresses",
                              lambda: wh.initial_addresses(raw, customers))
            fo = self._submit(pool, self._table, step, "orders",
                              lambda: upkeep.with_year(wh.initial_orders(raw, customers)))
            products, orders = fp.result(), fo.result()
            self._table(step, "order_details", lambda: wh.initial_order_details(
                raw, upkeep.with_year(orders), products, carry=[upkeep.YEAR]))
            fa.result()
            self._drop_staging(owner)
        self._parts[step][upkeep.LINE_INDEX] = [upkeep.write_index(self, step, self._parts[step]["order_details"])]
        self.write("audit/initial-completed", lambda: audit.with_times(audit.audit_counted(
            self.spark, load_id, "INITIAL", "stage.raw_orders", self.rows(f"{self.root}/{step}/order_details"))))
        return self._core(step)

    def cleaned(self) -> wh.CoreState:
        def make():
            self.initial()
            before = self._parts["initial"]
            self._parts["cleanup"] = {**before, "addresses": upkeep.clean_up(self, "cleanup", before["addresses"])}
            return self._core("cleanup")
        return self._memoized("cleanup", make)

    def secondary(self) -> wh.CoreState:
        return self._memoized("secondary", self._build_secondary)

    def _build_secondary(self) -> wh.CoreState:
        self.cleaned()
        delta = self.delta_orders()
        load_id = self._open_load("secondary", "SECONDARY", "stage.delta_orders", "initial-started", "initial-completed")
        with keys.staging_scope() as owner:
            parts, counts = upkeep.incremental_load(self, "secondary", self._parts["cleanup"], delta)
            self._drop_staging(owner)
        self.write("audit/secondary-completed", lambda: audit.with_times(audit.audit_incremental(
            self.spark, load_id, "stage.delta_orders", self.rows(f"{self.root}/stage/delta_orders"), counts)))
        self._parts["secondary"] = parts
        return self._core("secondary")

    def audit_times(self) -> DataFrame:
        """When each load began and ended, from the kept log."""
        self.secondary()
        return audit.load_times(self.spark.read.schema(AUDIT_LOG).parquet(*[
            f"{self.root}/audit/{load}-{state}" for load in ("initial", "secondary") for state in ("started", "completed")]))

    def audit_log(self) -> DataFrame:
        """The kept log of the loads: what each wrote when it began and when it ended."""
        self.secondary()
        return audit.audit_state(self._log_of(*[f"{load}-{state}" for load in ("initial", "secondary")
                                                for state in ("started", "completed")]))

    def corrected(self) -> wh.CoreState:
        """Period correction. Only parts of the period's years are read, and of
        those only the ones that hold deleted rows are rewritten; all other
        parts are shared with the previous step."""
        def make():
            self.secondary()
            before = self._parts["secondary"]
            years = range(CORRECTION.start.year, CORRECTION.end.year + 1)
            inside = {t: [p for p in before[t] if upkeep.part_year(p) in years] for t in upkeep.BY_YEAR}
            orders, details = (upkeep.read(self.spark, t, inside[t]) for t in upkeep.BY_YEAR)
            _, _, doomed, orphans = wh.correct_period(orders, details, CORRECTION)
            # The deleted ids, written once: a record of the correction, and
            # read (not recomputed) by the part checks and rewrites below.
            doomed = self.snapshot("correction/deleted_order_details", lambda: doomed)
            orphans = self.snapshot("correction/deleted_orders", lambda: orphans)
            parts = {t: before[t] for t in TABLES}      # rewritten line parts have no index: they are always read
            todo = []
            checks = (("order_details", "order_detail_id", doomed), ("orders", "order_id", orphans))
            with ThreadPoolExecutor(max_workers=2) as pool:       # independent checks
                hits = list(pool.map(lambda c: self._touched_parts(inside[c[0]], c[1], c[2]), checks))
            for (t, key, gone), hit in zip(checks, hits):
                moved = {p: f"{self.root}/correction/{t}/part{i}/{p.rsplit('/', 1)[1]}"
                         for i, p in enumerate(inside[t]) if i in hit}
                todo += [(out, lambda p=path, t=t, k=key, g=gone: upkeep.read(self.spark, t, [p])
                          .join(g.select(k), k, "left_anti")) for path, out in moved.items()]
                parts[t] = [moved.get(p, p) for p in before[t]]
            self._write_all(todo)
            self._parts["correction"] = parts
            return self._core("correction")
        return self._memoized("correction", make)

    def _touched_parts(self, paths: list[str], key: str, gone: DataFrame) -> set[int]:
        """Indices of the part folders containing any key of ``gone`` (at most
        one row per part comes back to the driver)."""
        if not paths:
            return set()
        tagged = None
        for i, p in enumerate(paths):
            part = self.read_parts([p]).select(key, F.lit(i).alias("_part"))
            tagged = part if tagged is None else tagged.unionByName(part)
        hits = tagged.join(gone.select(key), key, "left_semi").select("_part").distinct()
        return {r["_part"] for r in hits.collect()}

    def final(self) -> wh.CoreState:
        """The state that mart, rules and reports read: all loads applied. The
        period correction is a script of its own and not part of the run order."""
        return self.secondary()

    def fact_by_year(self) -> DataFrame:
        """The fact with its partition column: a filter on ``order_year`` prunes folders."""
        s = self.final()
        return self._memoized("fact_sales", lambda: self.snapshot(
            "mart/fact_sales",
            # Each task of the join writes to the years it holds: the widest rows are not shuffled once more.
            lambda: mart.fact_sales(s.order_details, s.orders, s.addresses)
            .withColumn("order_year", F.year("order_date")),
            partition_by="order_year"))

    def fact_sales(self) -> DataFrame:
        return self.fact_by_year().drop("order_year")

    def mart(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The three mart tables; the two materialised ones are built
        concurrently (they only share their inputs)."""
        self.final()
        with ThreadPoolExecutor(max_workers=2) as pool:
            ff = pool.submit(self.fact_sales)
            fc = pool.submit(self.dim_customers)
            return ff.result(), self.dim_products(), fc.result()

    def dim_products(self) -> DataFrame:
        return mart.dim_products(self.final().products)

    def dim_customers(self) -> DataFrame:
        s = self.final()
        return self._memoized("dim_customers", lambda: self.snapshot(
            "mart/dim_customers", lambda: mart.dim_customers(s.customers, s.addresses)))


    def register_views(self, prefix: str = "") -> list[str]:
        """The mart (and final core tables) as temp views, for ``spark.sql``:
        ``dim_products``, ``dim_customers``, ``fact_sales`` and ``core_*``."""
        views = {"dim_products": self.dim_products(), "dim_customers": self.dim_customers(),
                 "fact_sales": self.fact_sales()}
        views.update({f"core_{t}": df for t, df in self.final().tables().items()})
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + n for n in views]


def warehouse(spark: SparkSession, sf_dir: str) -> WarehouseRun:
    """The (memoised) warehouse run of a session and the input files as they are now."""
    digest, size = input_state(spark, sf_dir)
    size_shuffles(spark, size)
    size_broadcasts(spark)
    key = (spark.sparkContext.applicationId, sf_dir, NAMESPACE, digest)
    with _RUNS_LOCK:
        run = _RUNS.get(key)
        if run is None:
            run = _RUNS[key] = WarehouseRun(spark, sf_dir, digest)
        return run
