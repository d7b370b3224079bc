"""Session defaults and the shared folder used to cut lineage."""

from pyspark.sql import DataFrame, SparkSession


def build_session(app="tallyleaf", master=None, **conf):
    """A session with the settings the jobs are written for; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may do without: there driver and executors are one process, and the warehouse folder serves.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = spark.conf.get("spark.sql.warehouse.dir") + "/shared"
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that losing an executor does not replay earlier rounds.

    Spark takes the product of its sides for the size of a join and carries it over a checkpoint, so the number of its digits
    grows by a factor from round to round, and every plan on the driver holds it. One that is past all bounds is replaced by Spark's own
    for an unknown size; no join is planned otherwise for it, and sizes measured at run time count as before.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return _sized(df.checkpoint(eager=True))


def _sized(kept: DataFrame) -> DataFrame:
    plan, jvm = kept._jdf.queryExecution().analyzed(), kept.sparkSession._jvm
    try:
        known = plan.stats().sizeInBytes().bit_length() < 63
    except ValueError:  # It has more digits than Python reads.
        known = False
    if known:
        return kept
    none, session = jvm.scala.Option.empty(), kept.sparkSession._jsparkSession
    scan = plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), False, plan.stream()
    unsized = jvm.org.apache.spark.sql.execution.LogicalRDD(plan.output(), *scan, session, none, none)
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, unsized), kept.sparkSession)
