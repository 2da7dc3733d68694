"""Per-session materialisation of the derived views.

Every query of a session reads the same few derived views (the contest view
is a four-way join over the largest tables; the panels and profiles sit on
top of it). Rebuilding them per query would repeat the big joins and
shuffles once per query. A ``Workspace`` builds each view once, writes it as
Parquet under the cluster's shared ``spark.checkpoint.dir`` (this also cuts
the lineage, so a lost executor recomputes from the written table, not from
the raw tables) and serves later queries from it with column pruning and
filter pushdown. This mirrors the batch design being rebuilt: build the
unified history once, then answer every page from it.

Set ``spark.conf.set("arenaspark.materialize", "false")`` to get the purely
lazy views instead (same results, no writes), and ``arenaspark.workspace.dir``
to place the views in another shared folder (a warehouse location).
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from arenaspark.plans import bindings as B
from arenaspark.session import ensure_checkpoint_dir

_LOCK = threading.Lock()  # held for a dictionary access only
_SPACES: dict = {}
SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _state(spark: SparkSession, sf: str) -> str:
    """Names, sizes and times of the source files: views of another state are not used."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    seen = []
    for t in SOURCE_TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf}/{t}.parquet")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            seen += [f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.listStatus(p)]
    return hashlib.sha1("|".join(seen).encode()).hexdigest()[:10]


class Workspace:
    def __init__(self, spark: SparkSession, sf: str, state: str = ""):
        self.spark, self.sf = spark, sf.rstrip("/")
        self.materialize = spark.conf.get("arenaspark.materialize", "true").lower() != "false"
        tag = hashlib.sha1(self.sf.encode()).hexdigest()[:10]
        app = spark.sparkContext.applicationId
        base = spark.conf.get("arenaspark.workspace.dir", None) or ensure_checkpoint_dir(spark)
        self.tag = f"{tag}-{state}"
        self.root = f"{base.rstrip('/')}/arenaspark-views/{app}/{self.tag}"
        self._done: dict = {}
        self._locks: dict[str, threading.RLock] = {}

    def artefact(self, name: str) -> str:
        """Folder for what is fitted on this state of the source files. In a named workspace folder
        (``arenaspark.workspace.dir``) it outlives the session: an unchanged source finds it again."""
        named = self.spark.conf.get("arenaspark.workspace.dir", None)
        return f"{named.rstrip('/')}/arenaspark-models/{self.tag}/{name}" if named else f"{self.root}/{name}"

    def once(self, name: str, make):
        """What ``make(path)`` returned when first asked for under ``name``; path is a folder of its own."""
        with _LOCK:
            own = self._locks.setdefault(name, threading.RLock())
        with own:  # one writer per name; others and other data sets go on
            if name not in self._done:
                self._done[name] = make(f"{self.root}/{name}")
        return self._done[name]

    def _view(self, name: str, build) -> DataFrame:
        if not self.materialize:
            return build()

        def write(path: str) -> str:
            build().write.mode("overwrite").parquet(path)
            return path

        return self.spark.read.parquet(self.once(name, write))

    def clear(self) -> None:
        """Remove the written views; they are built anew when next asked for."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self._done.clear()

    # ----------------------------------------------------------- the views
    def contests(self) -> DataFrame:
        """Contest view with venue, city and the stored text (queries prune
        what they skip)."""
        return self._view("contests", lambda: B.contests(self.spark, self.sf, venue=True, city=True,
                                                         keep_raw_text=True))

    def contests_b(self) -> DataFrame:
        """Second contest source (returned items, customer side)."""
        if not self.materialize:
            return B.contests_b(self.spark, self.sf)
        return B.contests_b_from(self.contests())

    def panel(self) -> DataFrame:
        return self._view("panel", lambda: B.panel(self.spark, self.sf, self.contests()))

    def profiles(self) -> DataFrame:
        return self._view("profiles", lambda: B.profiles(self.spark, self.sf, self.panel()))

    def editions(self) -> DataFrame:
        return self._view("editions", lambda: B.editions(self.spark, self.sf, self.panel()))

    def ranking(self) -> DataFrame:
        return self._view("ranking", lambda: B.ranking(self.spark, self.sf))

    def labels(self) -> DataFrame:
        return B.labels(self.spark, self.sf, self.ranking())

    def cust_panel(self) -> DataFrame:
        return self._view("cust_panel", lambda: B.cust_panel(self.spark, self.sf))

    def cust_profiles(self) -> DataFrame:
        """All-time row per customer; customers miss years, so experience varies."""
        return self._view("cust_profiles", lambda: B.profiles(self.spark, self.sf, self.cust_panel()))

    def derived(self, name: str, build) -> DataFrame:
        """Materialise any other derived table of this session once."""
        return self._view(name, build)

    def cust_panel_next(self) -> DataFrame:
        return self._view("cust_panel_next", lambda: B.cust_panel_next(self.spark, self.sf, self.cust_panel()))


def workspace(spark: SparkSession, sf: str) -> Workspace:
    """The session's workspace over ``sf``; changed source files get a new one and the old one's views go."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"),
           spark.conf.get("arenaspark.materialize", "true"))
    state = _state(spark, sf.rstrip("/"))
    with _LOCK:
        old = _SPACES.get(key)
        if old is None or old[0] != state:
            _SPACES[key] = (state, Workspace(spark, sf, state))
        space = _SPACES[key][1]
    if old is not None and old[0] != state:
        old[1].clear()
    return space
