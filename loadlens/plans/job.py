"""A whole load test: requests in, predictions, metric tables, summary and projection out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.paths import run_label
from loadlens.operators.assets import fetch_content, match_assets
from loadlens.operators.partitions import spread_by_bytes, spread_for_scoring, waves
from loadlens.operators.sampling import balanced_sample, runs_of
from loadlens.operators.scoring import Scorer, score
from loadlens.plans.capacity import BURST_LEVELS, REQUEST_SIZE, burst_drain
from loadlens.plans.runs import demo_summary, load_test_tables
from loadlens.sinks.files import write_copies, write_metrics, write_parquet
from loadlens.sinks.snapshots import publish

RUN = ["run_label"]


@dataclass(frozen=True)
class LoadTest:
    """Settings of a load test. Without ``sizes`` there is one run over all requests.

    ``root`` holds published tests (``sinks.snapshots``): this one takes the place of an earlier one when
    all of it is written, and until then, or if it breaks, the earlier one is what readers find. The
    ``mirrors`` get the metric tables afterwards. ``otherwise`` is the
    size of the one run to make where none of ``sizes`` can be filled; without it that is an error.
    ``slots`` are the task slots of the cluster, as the session names them by default.
    """

    root: str
    sizes: Sequence[int] | None = None
    otherwise: int | None = None
    order: Sequence[str] = ("request_id",)
    inputs: Sequence[str] = ()
    carry: Sequence[str] = ()
    slots: int | None = None
    unit: str = "reqs"
    formats: Sequence[str] = ("parquet", "csv", "json")
    levels: Sequence[int] = BURST_LEVELS
    request_size: int = REQUEST_SIZE
    mirrors: Sequence[str] = field(default_factory=tuple)


def with_content(requests: DataFrame, listing: DataFrame, slots: int | None = None) -> DataFrame:
    """Requests whose file is listed, with its bytes in ``content``, read where they are used.

    With ``slots`` the requests are dealt to tasks of equal bytes first, by ``file_size_bytes``; else
    they stay in the tasks of the narrow rows, which may be few.
    """
    if slots is None:
        return fetch_content(match_assets(requests, listing.select("file_path")))
    found = match_assets(requests, listing.select("file_path", F.col("file_size_bytes").alias("_length")))
    return fetch_content(spread_by_bytes(found, "_length", _sized_waves(found, slots)))


def _sized_waves(rows: DataFrame, slots: int) -> int:
    """Tasks for rows with their bytes in ``_length``."""
    count, total = rows.agg(F.count(F.lit(1)), F.sum("_length")).first()
    return waves(count, slots, total_bytes=total or 0)


def run_load_test(
    requests: DataFrame, scorer: Scorer, test: LoadTest, listing: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Score one run per size, then compute every table over all runs at once.

    With a ``listing`` of files the requests are matched to it, and every task reads the files of
    its own rows, which the scorer gets as ``content``.

    Runs go one after the other, since what is measured is one load at a time. Each is written
    to its own partition of the prediction table before anything reads it, so no score is
    computed twice and a lost executor costs only its tasks. Where the listing has
    ``file_size_bytes``, tasks get equal shares of bytes, else of rows.
    """
    spark = requests.sparkSession
    inputs = list(test.inputs)
    sized = listing is not None and "file_size_bytes" in listing.columns
    if listing is not None:
        size = [F.col("file_size_bytes").alias("_length")] if sized else []
        requests = match_assets(requests, listing.select("file_path", *size))
        inputs.append("content")
    if test.sizes is None:
        rows, sizes = requests, [requests.count()]
    else:
        sizes, rows = runs_of(requests, test.sizes, test.order, test.otherwise)
    if not sizes[0]:
        raise ValueError("no requests to score")
    slots = test.slots or spark.sparkContext.defaultParallelism
    made: dict[str, DataFrame] = {}

    def write(root: str) -> None:
        stored = f"{root}/predictions"
        schema = None
        for index, size in enumerate(sizes, start=1):
            run = rows if test.sizes is None else rows.filter(F.col("_rn") <= size)
            run = run.withColumn("run_label", run_label(F.lit(index), F.lit(size), test.unit))
            if sized:
                run = spread_by_bytes(run, "_length", _sized_waves(run, slots))
            else:
                run = spread_for_scoring(run, waves(size, slots))
            run = run if listing is None else fetch_content(run)
            scored = score(run, scorer, inputs, [*test.carry, "run_label"])
            schema = scored.schema
            write_parquet(scored, stored, RUN, keep_others=index > 1)
        # Partition columns come last when read back.
        pred = spark.read.schema(schema).parquet(stored).select(*schema.names)
        write_copies(pred, root, test.formats)
        tables = load_test_tables(pred)
        tables["burst_drain"] = burst_drain(
            tables["load_test_summary"],
            "wall_throughput_req_per_sec",
            levels=test.levels,
            request_size=test.request_size,
            unit="requests",
        )
        write_metrics(tables, [f"{root}/metrics"])
        made.update({"predictions": pred, **tables})

    publish(spark, test.root, write)
    if test.mirrors:
        write_metrics({n: t for n, t in made.items() if n != "predictions"}, test.mirrors)
    return made


def run_sample_test(
    requests: DataFrame,
    scorer: Scorer,
    root: str,
    per_class: int,
    listing: DataFrame | None = None,
    label: str = "true_label",
    order: Sequence[str] = ("file_path", "request_id"),
    inputs: Sequence[str] = (),
    from_topic: bool = False,
) -> dict[str, DataFrame]:
    """Score a balanced sample and sum the run up: predictions and a summary of one row."""
    spark, root = requests.sparkSession, root.rstrip("/")
    rows = balanced_sample(requests, per_class, label, order)
    inputs = list(inputs)
    if listing is not None:
        rows, inputs = with_content(rows, listing), [*inputs, "content"]
    scored = score(spread_for_scoring(rows, spark.sparkContext.defaultParallelism), scorer, inputs)
    write_parquet(scored, f"{root}/predictions")
    pred = spark.read.schema(scored.schema).parquet(f"{root}/predictions")
    summary = demo_summary(pred, listing is not None, from_topic, by=())
    write_metrics({"demo_summary": summary}, [f"{root}/metrics"])
    return {"predictions": pred, "demo_summary": summary}
