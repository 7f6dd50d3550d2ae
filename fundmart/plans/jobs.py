"""Jobs: raw files to prepared tables, prepared tables to star and report, whole folder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.functions.pseudonym import key_for_files, load_key
from fundmart.layouts import (
    HEADER,
    LABEL,
    LAYOUT_OF_KIND,
    LAYOUT_VERSION,
    TRAILER,
    merged_record,
    prepared_schema,
    record_types,
)
from fundmart.operators.checks import QualityError, gate, status
from fundmart.operators.merge import template
from fundmart.plans.contracts import STAR_CONTRACTS, check_tables
from fundmart.plans.delivery_checks import (
    ORDER,
    check_deliveries,
    empty_messages,
    first_row,
    with_source,
)
from fundmart.plans.report import delivery_coverage, write_report
from fundmart.plans.star import PARTITIONED, build_star
from fundmart.session import Stage
from fundmart.sinks import (
    check_format,
    refuse_other_format,
    remove_stale,
    without_helpers,
    write_table,
    write_tables,
)
from fundmart.sources.files import (
    checksums,
    delivery_files,
    file_heads,
    files_at,
    list_files,
    mark_duplicates,
    with_guard,
)
from fundmart.sources.lines import latin1_files, raw_lines, text_lines
from fundmart.sources.names import deliveries as recognised
from fundmart.sources.names import unrecognised
from fundmart.sources.prepared import (
    DELIVERY,
    MESSAGE_COUNT,
    MESSAGES,
    prepared_tables,
    read_csv_table,
    read_star,
    read_table,
    stack_prepared,
    stored_messages,
    table_schema,
)
from fundmart.sources.records import (
    BLANK,
    UNKNOWN,
    route,
    split_table,
    stage_lines,
    staged_messages,
    typed_table,
)
from fundmart.texts import (
    DUPLICATE_FILE,
    EMPTY_FILE,
    FILE_SEVERITY,
    NO_HEADER,
    OK,
    STAR_SOURCE,
    UNKNOWN_FILE,
)

DATAMODEL = "datamodel"


@dataclass
class FileError:
    """A file that is not in the prepared tables, and why."""

    path: str
    stem: str
    kind: str
    check: str
    text: str


@dataclass
class Prepared:
    """Outcome of :func:`prepare_files`."""

    labels: list[str] = field(default_factory=list)
    errors: list[FileError] = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    messages: DataFrame | None = None


@dataclass
class Outcome:
    """Outcome of :func:`process_folder`."""

    labels: list[str] = field(default_factory=list)
    star: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    status: str = OK
    messages: DataFrame | None = None


def find_files(spark: SparkSession, raw: str) -> DataFrame:
    """Recognised deliveries under a folder, in path order."""
    found = recognised(delivery_files(list_files(spark, raw)))
    return found.orderBy(F.split("Pad", "/"))


def unrecognised_files(spark: SparkSession, raw: str) -> DataFrame:
    found = unrecognised(delivery_files(list_files(spark, raw)), "Bestandsnaam")
    return found.orderBy(F.split("Pad", "/"))


def _delivery_rows(
    spark: SparkSession,
    files: DataFrame,
    header: DataFrame,
    messages: DataFrame,
    pseudonymised: bool,
) -> DataFrame:
    """The ``LEVERING`` table: one row per delivery."""
    first = first_row(header, [LABEL], ["BRIN", "DatumAanmaak"]).withColumnRenamed("BRIN", "_brin")
    counts = messages.groupBy(LABEL).agg(F.count("*").alias("_n"))
    return (
        files.join(first, LABEL)
        .join(checksums(files), "uri", "left")
        .join(counts, LABEL, "left")
        .select(
            LABEL,
            F.col("Soort").alias("SoortLevering"),
            "Bekostigingsjaar",
            "DatumAanmaak",
            F.col("_brin").alias("BrinOntvanger"),
            "Bestandsnaam",
            "Sha256",
            F.lit(LAYOUT_VERSION).alias("SchemaVersie"),
            F.lit(pseudonymised).alias("Gepseudonimiseerd"),
            F.coalesce("_n", F.lit(0)).cast("bigint").alias(MESSAGE_COUNT),
        )
        .select(table_schema(DELIVERY).names)
    )


def prepare_files(
    spark: SparkSession,
    files: DataFrame,
    target: str,
    fmt: str,
    key: bytes | None,
) -> Prepared:
    """Raw files to prepared tables under ``target``, all files in one job.

    The text is read twice: once for the encoding of each file, once to route its
    lines (person numbers hidden) into one staged table. Record tables, numbers
    and checks all come from that table, so they see the same rows.
    """
    refuse_other_format(spark, target, prepared_tables(), fmt)
    result = Prepared()
    # Names, not data: the scan needs the list of paths anyway.
    chosen = files.select("Pad", "uri", LABEL, "Soort", "Bestandsnaam").collect()
    if not chosen:
        return result
    paths = [row["Pad"] for row in chosen]
    with Stage(spark) as stage:
        names = stage.write(files.drop("Eerste", "Dubbel"), "files")
        raw = raw_lines(spark, paths)
        latin1 = [row[0] for row in latin1_files(raw).collect()]
        staged = stage_lines(stage, route(text_lines(raw, latin1), key))
        splits = stage.write(split_table(staged), "splits")
        counts = splits.groupBy(LABEL, "tabel").agg(F.sum("n").alias("n"))
        counts = stage.write(counts, "counts")
        # One row per delivery and record type.
        found: dict[str, dict[str, int]] = {}
        for row in counts.filter(F.col("tabel") != BLANK).collect():
            found.setdefault(row[LABEL], {})[row["tabel"]] = row["n"]
        for row in chosen:
            has = found.get(row[LABEL], {})
            if not has:
                text = EMPTY_FILE % row["Pad"]
            elif HEADER not in has:
                text = NO_HEADER % row["Bestandsnaam"]
            else:
                result.labels.append(row[LABEL])
                continue
            result.errors.append(
                FileError(row["Pad"], row[LABEL], row["Soort"], "Bestand", text)
            )
        if result.labels:
            _write_prepared(
                spark, stage, names, staged, splits, counts, found, result, target, fmt, key
            )
    return result


def _write_prepared(
    spark: SparkSession,
    stage: Stage,
    names: DataFrame,
    staged: DataFrame,
    splits: DataFrame,
    counts: DataFrame,
    found: dict[str, dict[str, int]],
    result: Prepared,
    target: str,
    fmt: str,
    key: bytes | None,
) -> None:
    accepted = F.col(LABEL).isin(result.labels)
    files = names.filter(accepted)
    staged, splits = staged.filter(accepted), splits.filter(accepted)
    written: set[tuple[str, str]] = set()
    found_tables: dict[str, DataFrame] = {}
    for rs in record_types():
        labels = [label for label in result.labels if found[label].get(rs)]
        written |= {(rs, label) for label in labels}
        if labels:
            found_tables[rs] = typed_table(staged, splits, rs).select(table_schema(rs).names)
    if fmt == "csv":
        typed = {rs: stage.write(df, rs) for rs, df in found_tables.items()}
        # All partitions of a table have the same columns, whatever a delivery holds.
        export = {rs: without_helpers(df) for rs, df in typed.items()}
        write_tables(export, target, fmt, tuple(export), keep_others=True)
    else:
        write_tables(found_tables, target, fmt, tuple(found_tables), keep_others=True)
        typed = {rs: read_table(spark, target, rs).filter(accepted) for rs in found_tables}
    for rs in (HEADER, TRAILER):
        typed.setdefault(rs, template(spark, prepared_schema(merged_record(rs))))
    known = counts.filter(accepted & ~F.col("tabel").isin(BLANK, UNKNOWN))
    messages = stage.write(
        check_deliveries(typed, staged_messages(staged, splits), files, known), "messages"
    )
    rows = stage.write(
        _delivery_rows(spark, files, typed[HEADER], messages, key is not None), "deliveries"
    )
    own = {MESSAGES: messages.select(table_schema(MESSAGES).names), DELIVERY: rows}
    if fmt == "csv":
        own = {name: without_helpers(df) for name, df in own.items()}
    write_tables(own, target, fmt, tuple(own), keep_others=True)
    with_messages = [row[0] for row in messages.select(LABEL).distinct().collect()]
    written |= {(MESSAGES, label) for label in with_messages}
    written |= {(DELIVERY, label) for label in result.labels}
    remove_stale(spark, target, prepared_tables(), result.labels, written)
    if fmt == "parquet":
        stored = {n: read_table(spark, target, n) for n in prepared_tables()}
        result.tables = {n: df.filter(accepted) for n, df in stored.items() if df is not None}
        result.messages = result.tables.get(MESSAGES)
        if result.messages is None:
            result.messages = template(spark, table_schema(MESSAGES))
    else:
        # Read back what was written: results must outlive the staged tables.
        result.tables = {
            n: read_csv_table(spark, target, n).filter(accepted)
            for n in dict.fromkeys(name for name, _ in written)
        }
        result.messages = result.tables.setdefault(
            MESSAGES, template(spark, table_schema(MESSAGES))
        )


def run_pipeline(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "parquet",
    key: bytes | None = None,
    pseudonymise: bool = True,
    fail_on_errors: bool = True,
) -> Prepared:
    """One raw file to prepared tables; raises on a file that cannot be processed.

    With status ``fail`` and ``fail_on_errors`` it raises after writing.
    """
    check_format(fmt)
    if pseudonymise and key is None:
        key = load_key()
    listed = delivery_files(files_at(spark, [source]))
    known = recognised(listed)
    if known.isEmpty():
        name = source.rsplit("/", 1)[-1]
        raise ValueError(UNKNOWN_FILE % (repr(name), sorted(LAYOUT_OF_KIND)))
    result = prepare_files(spark, known, target, fmt, key if pseudonymise else None)
    if result.errors:
        raise ValueError(result.errors[0].text)
    if fail_on_errors:
        gate(with_source(result.messages, F.col(LABEL)), f"zie de tabel {MESSAGES} in {target}")
    return result


def _star_and_report(
    spark: SparkSession,
    roots: list[str],
    target: str,
    allowed: bool,
    labels: list[str] | None = None,
    only: list[str] | None = None,
    file_messages: DataFrame | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    stacked = stack_prepared(spark, roots, labels)
    if only is not None:
        stacked = {n: df.filter(F.col(LABEL).isin(only)) for n, df in stacked.items()}
    built = build_star(spark, stacked)
    for name in built:
        if name.startswith("dim_"):
            built[name] = built[name].orderBy(*STAR_CONTRACTS.grain[name])
    write_tables(built, f"{target}/{DATAMODEL}", partitioned=PARTITIONED)
    # The contracts read what was written, instead of building it all again.
    star = read_star(spark, f"{target}/{DATAMODEL}")
    with Stage(spark) as stage:
        messages = stored_messages(spark, stacked).unionByName(
            with_source(check_tables(star), STAR_SOURCE).withColumn(
                ORDER, F.concat_ws("/", "Controle", "Recordsoort", "Melding")
            )
        )
        if file_messages is not None:
            messages = messages.unionByName(file_messages.withColumn(ORDER, F.lit("0")))
        messages = stage.write(messages, "messages")
        deliveries = star["dim_levering"]
        covered = delivery_coverage(spark, stacked, deliveries)
        write_report(spark, target, messages, deliveries, allowed, covered, ORDER)
        kept = _keep(spark, messages, target)
    return star, kept


def _keep(spark: SparkSession, messages: DataFrame, target: str) -> DataFrame:
    """Messages as a table beside the report, so they outlive the job's own folder."""
    path = f"{target}/{MESSAGES}"
    write_table(messages, path)
    return spark.read.schema(messages.schema).parquet(path).drop(ORDER)


def run_star(
    spark: SparkSession,
    sources: list[str],
    target: str,
    fail_on_errors: bool = True,
    labels: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Prepared folders to ``<target>/datamodel`` and ``<target>/quality.json``."""
    star, messages = _star_and_report(spark, sources, target, not fail_on_errors, labels)
    if fail_on_errors:
        gate(messages, f"zie {target}/quality.json")
    return star


def process_folder(
    spark: SparkSession,
    raw: str,
    prepared: str,
    output: str,
    key: bytes | None = None,
    pseudonymise: bool = True,
    demo_key: str | None = None,
    demo_brin: str | None = None,
) -> Outcome:
    """All recognised files of a folder, then the star; never raises on quality.

    A file that cannot be processed, or that repeats another, becomes a message
    and an entry in ``errors``; the other files go on. ``demo_key`` is a public key for
    synthetic files of institution ``demo_brin``: without an own key it is used, unless
    some file is real; then nothing of any file but its first line has been read.
    """
    if pseudonymise and key is None:
        key = load_key() if demo_key is None else _key_for(spark, raw, demo_key, demo_brin)
    outcome = Outcome()
    base = spark._jvm.org.apache.hadoop.fs.Path(raw)
    filesystem = base.getFileSystem(spark._jsc.hadoopConfiguration())
    root = filesystem.makeQualified(base).toString()
    files = mark_duplicates(find_files(spark, raw), "Bestandsnaam", "Pad")
    repeated = files.filter("Dubbel").orderBy(F.split("Pad", "/")).collect()
    done = prepare_files(
        spark, files.filter(~F.col("Dubbel")), prepared, "parquet", key if pseudonymise else None
    )
    outcome.labels = sorted(done.labels)
    errors = list(done.errors)
    for row in repeated:
        text = DUPLICATE_FILE % _relative(row["Eerste"], root)
        errors.append(FileError(row["Pad"], row[LABEL], row["Soort"], "Dubbel", text))
    for error in errors:
        name = error.path.rsplit("/", 1)[-1]
        shown = _relative(error.path, root) if error.check == "Dubbel" else name
        outcome.errors[shown] = error.text
    rows = [(e.stem, e.check, e.kind, e.text, 1, FILE_SEVERITY[e.check]) for e in errors]
    empty = empty_messages(spark)
    file_messages = spark.createDataFrame(rows, empty.schema) if rows else empty
    roots = [prepared] if outcome.labels else []
    outcome.star, outcome.messages = _star_and_report(
        spark, roots, output, False, only=outcome.labels, file_messages=file_messages
    )
    outcome.status = status(outcome.messages)
    return outcome


def _key_for(spark: SparkSession, raw: str, demo_key: str, demo_brin: str | None) -> bytes:
    files = find_files(spark, raw)
    return key_for_files(with_guard(files, file_heads(files), demo_brin or ""), demo_key)


def _relative(path: str, root: str) -> str:
    return path.removeprefix(root.rstrip("/") + "/")


__all__ = [
    "FileError",
    "Outcome",
    "Prepared",
    "QualityError",
    "find_files",
    "prepare_files",
    "process_folder",
    "run_pipeline",
    "run_star",
    "unrecognised_files",
]
