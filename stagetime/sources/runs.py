"""Runs: a log of commits by which raw batches and derived tables become visible together, or not at all.

A run writes its files to a folder of its own attempt, which nothing reads, and then adds one numbered commit
that names them: what was read up to (the watermark), how many rows each table has and their fingerprint.
The commit is written aside and renamed to its number only if no commit has that number, so of two
runs that follow the same commit one fails, and a run that dies before its commit has changed nothing.
The rename is atomic where the file system's is, as on HDFS; a store without it needs a conditional put.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fingerprint, row_hash

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "stagetime:runs")
RAW = "raw"

Derive = Callable[[DataFrame, int], dict[str, DataFrame]]


class Clash(ValueError):
    """Another run has added the commit that this one was to add."""


def workspace(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share; in local mode a temporary one if none is set."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stagetime-")
    return f"{root}/stagetime-{uuid.uuid4().hex}"


def run_id(product: str, day: str) -> str:
    """The id of a product's run of a day, the same whenever it is asked for."""
    return str(uuid.uuid5(NAMESPACE, f"{product}:{day}"))


class CommitLog:
    """Commits 1, 2, ... under a root, each one JSON file that is never written over."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        return self._fs.Path(f"{self.root}/commits/{name}")

    def commits(self, upto: int | None = None) -> list[dict]:
        """All commits in their order, or those up to a version."""
        folder = self._fs.Path(f"{self.root}/commits")
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return []
        texts = self.spark.read.text(f"{self.root}/commits", wholetext=True, pathGlobFilter="*.json").collect()  # one small file for each run
        found = sorted((json.loads(r["value"]) for r in texts), key=lambda c: c["version"])
        return [c for c in found if upto is None or c["version"] <= upto]

    def head(self) -> dict | None:
        found = self.commits()
        return found[-1] if found else None

    def add(self, commit: dict) -> dict:
        """Makes a commit visible under its number; raises Clash if there is one of that number."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        aside, to = self._path(f".{uuid.uuid4().hex}"), self._path(f"{commit['version']:012d}.json")
        out = aside.getFileSystem(conf).create(aside, False)
        out.write(bytearray(json.dumps(commit).encode()))
        out.close()
        rename = getattr(self._fs, "Options$Rename")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), conf).rename(aside, to, gateway.new_array(rename, 0))
        except Py4JJavaError as why:
            aside.getFileSystem(conf).delete(aside, False)
            if "FileAlreadyExistsException" in str(why.java_exception.getClass().getName()):
                raise Clash(f"version {commit['version']} is committed already") from None
            raise
        return commit


def _written(df: DataFrame, path: str) -> dict:
    """Writes a table and tells its rows and fingerprint; raises if what can be read back differs from what was written."""
    seen = Observation()
    digest = F.coalesce(F.sum(row_hash(df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), digest.alias("digest")).write.parquet(path)
    back = fingerprint(df.sparkSession.read.schema(df.schema).parquet(path)).first()
    if (seen.get["n_rows"], seen.get["digest"]) != (back["n_rows"], back["digest"]):
        raise ValueError(f"{path}: what was written reads differently")
    return {"path": path, "rows": back["n_rows"], "digest": str(back["digest"])}


def raw_rows(spark: SparkSession, root: str, schema, version: int | None = None) -> DataFrame:
    """The raw rows that the commits up to a version hold, whatever has landed since."""
    paths = [c["tables"][RAW]["path"] for c in CommitLog(spark, root).commits(version) if RAW in c["tables"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A derived table as of a version: that of the last commit which has it."""
    facts = [c["tables"][name] for c in CommitLog(spark, root).commits(version) if name in c["tables"]]
    if not facts:
        raise ValueError(f"no commit has a table {name}")
    return spark.read.parquet(facts[-1]["path"])


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], cut: int, run: str, watermark: int | None = None, more: dict | None = None) -> dict:
    """Writes tables to an attempt's folder and commits them together; a cut before the last one is refused.

    A run that is committed already is not run again: its commit is returned and nothing is written.
    """
    log = CommitLog(spark, root)
    found = log.commits()
    for c in found:
        if c["run"] == run:
            return c
    if found and found[-1]["cut"] >= cut:
        raise ValueError(f"cut {cut} is not after the published one, {found[-1]['cut']}")
    attempt = f"{root}/data/{run}/{uuid.uuid4().hex}"
    facts = {name: _written(df, f"{attempt}/{name}") for name, df in tables.items()}
    return log.add({"version": len(found) + 1, "run": run, "cut": cut, "watermark": watermark, "tables": facts, **(more or {})})


def advance(spark: SparkSession, root: str, source: DataFrame, run: str, cut: int, overlap: int, key: str = "event_id", derive: Derive | None = None) -> dict:
    """One run: reads source(key, at, ...) from the watermark on, keeps new rows, derives tables, commits all of it.

    The read begins overlap microseconds before the last committed watermark and ends before cut; rows whose
    key is stored already in that span are left out, so nothing is kept twice and late rows inside the overlap are
    found.  The watermark is the greatest `at` that is stored, and moves only with the commit.
    """
    log = CommitLog(spark, root)
    last = log.head()
    for c in log.commits():
        if c["run"] == run:
            return c
    mark = last["watermark"] if last else None
    read = source.filter(F.col("at") < cut) if mark is None else source.filter((F.col("at") < cut) & (F.col("at") >= mark - overlap))
    stored = raw_rows(spark, root, source.schema)
    known = stored.select(key) if mark is None else stored.filter(F.col("at") >= mark - overlap).select(key)
    fresh = read.dropDuplicates([key]).join(known, key, "left_anti").select(*source.columns)
    attempt = f"{root}/data/{run}/{uuid.uuid4().hex}"
    facts = {RAW: _written(fresh, f"{attempt}/{RAW}")}
    new = spark.read.schema(source.schema).parquet(facts[RAW]["path"])
    got = new.agg(F.max("at").alias("at")).first()["at"]
    version = last["version"] + 1 if last else 1
    if last and last["cut"] >= cut:
        raise ValueError(f"cut {cut} is not after the published one, {last['cut']}")
    for name, df in (derive(stored.unionByName(new), cut) if derive else {}).items():
        facts[name] = _written(df, f"{attempt}/{name}")
    watermark = max((x for x in (mark, got) if x is not None), default=None)
    return log.add({"version": version, "run": run, "cut": cut, "watermark": watermark, "read": read.count(), "tables": facts})


def replay(spark: SparkSession, root: str, schema, derive: Derive, version: int | None = None) -> dict[str, bool]:
    """For each derived table of a commit, whether the raw rows of that version give it again; no source is read."""
    commit = CommitLog(spark, root).commits(version)[-1]
    made = derive(raw_rows(spark, root, schema, commit["version"]), commit["cut"])
    same = {}
    for name, df in made.items():
        facts, got = commit["tables"][name], fingerprint(df).first()
        same[name] = [got["n_rows"], str(got["digest"])] == [facts["rows"], facts["digest"]]
    return same


def verified(spark: SparkSession, root: str) -> bool:
    """Whether every table that the last commit names still has its count and fingerprint."""
    now = CommitLog(spark, root).head()
    if not now:
        return False
    got = {name: fingerprint(spark.read.parquet(facts["path"])).first() for name, facts in now["tables"].items()}
    return all([x["n_rows"], str(x["digest"])] == [now["tables"][n]["rows"], now["tables"][n]["digest"]] for n, x in got.items())
