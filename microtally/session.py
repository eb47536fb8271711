"""Session settings and the scratch folder shared by all executors."""

import tempfile
import threading
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from microtally.errors import SourceError

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a table hashed on (survey_year, hhid) serve the join on
    # (survey_year, hhid, line_no) as well, so the wide side moves once.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # ... unless a key turns out skewed: then it is split, at the price of that shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Set when this package makes the session: without call-site capture, building a plan takes a
# fraction of the time.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are planned for."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app="microtally", master=None, **settings) -> SparkSession:
    """A session with the runtime settings; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**BUILD_SETTINGS, **settings}.items():
        builder = builder.config(name.replace("__", "."), value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise SourceError("set spark.checkpoint.dir to a folder shared by the executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="microtally-")
    return _LOCAL_ROOTS[application]


_LOCAL_ROOTS = {}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


# Independent tables worked on at the same time; their jobs share the executors.
PARALLEL_TABLES = 4


def in_parallel(spark: SparkSession, function, items) -> list:
    """Results of ``function`` for each item, in order, with a few jobs running at once."""
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        return list(pool.map(inheritable_thread_target(spark)(function), items))


# Set while large tables are worked on in parts: the shuffle files of a job go when it has ended,
# not when the driver happens to collect its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs started inside leave no shuffle files; threads of a session may be inside together."""
    session = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    with _REMOVING:
        inside, before = _INSIDE.get(session) or (0, spark.conf.get(REMOVE_SHUFFLES, "false"))
        _INSIDE[session] = inside + 1, before
        spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _REMOVING:
            inside, before = _INSIDE.pop(session)
            if inside > 1:
                _INSIDE[session] = inside - 1, before
            else:
                spark.conf.set(REMOVE_SHUFFLES, before)


_REMOVING, _INSIDE = threading.Lock(), {}


def checkpointed(df):
    """Materialise a frame in the scratch folder and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def send_package(spark: SparkSession) -> None:
    """Prepare Python workers: they get this package from the driver, once in an application."""
    if spark.sparkContext.applicationId not in _SENT:
        spark.sparkContext.addPyFile(_archive())
        _SENT.add(spark.sparkContext.applicationId)


def _archive():
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="microtally-")) / "microtally.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return str(path)


_SENT = set()
