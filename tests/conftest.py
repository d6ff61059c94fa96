import gc
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


def _stopped(session):
    """End the session and its JVM: what one module leaves behind cannot fail the next."""
    from pyspark import SparkContext

    session.stop()
    gateway, SparkContext._gateway, SparkContext._jvm = SparkContext._gateway, None, None
    gateway.shutdown()
    gateway.proc.stdin.close()
    try:
        gateway.proc.wait(20)
    except Exception:  # noqa: BLE001  it is only asked to end
        gateway.proc.kill()


def _forget_functions():
    """Decorated functions keep their counterpart in the JVM that first used them; the next one needs its own."""
    from pyspark.sql.udf import UserDefinedFunction

    for thing in gc.get_objects():
        if isinstance(thing, UserDefinedFunction):
            thing._judf_placeholder = None


@pytest.fixture(scope="module")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "3g")
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=256m -XX:G1PeriodicGCInterval=15000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # What finished jobs and queries leave in the status store, plans included, is not looked at.
        .config("spark.ui.retainedJobs", "10")
        .config("spark.ui.retainedStages", "10")
        .config("spark.ui.retainedTasks", "100")
        .config("spark.sql.ui.retainedExecutions", "2")
        .config("spark.sql.streaming.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    _stopped(session)
    _forget_functions()


def _resident(pid: int) -> int:
    """MB of a process in memory."""
    try:
        with open(f"/proc/{pid}/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGESIZE") >> 20
    except OSError:
        return 0


_tidy_count = [0]


@pytest.fixture(autouse=True)
def _tidy(request):
    """After each test nothing stays cached, and what the driver dropped is freed; TEST_MEMORY=file notes the JVM's memory."""
    yield
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    if session is None or "spark" not in request.fixturenames:
        return
    session.catalog.clearCache()
    _tidy_count[0] += 1
    if _tidy_count[0] % 8 == 0:
        gc.collect()
        session.sparkContext._jvm.System.gc()
    if os.environ.get("TEST_MEMORY"):
        with open(os.environ["TEST_MEMORY"], "a") as f:
            f.write(f"{_resident(session.sparkContext._gateway.proc.pid)} {request.node.nodeid}\n")
