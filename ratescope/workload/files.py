"""Price files and JSON pages that Spark writes from the star-schema tables, for the readers to read.

Rows are spread over a number of files that grows with the table; every file has its own lead lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.schemas import MANIFEST
from ratescope.sinks.scratch import scratch_path, shuffles_dropped
from ratescope.sources import packed
from ratescope.sources.ranges import list_files
from ratescope.workload import star

ROWS_PER_FILE = 20_000
ROWS_PER_PAGE = 500
# More files than this are written several a task.
_FEW_FILES, _FILES_PER_TASK = 64, 8
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PLANS = tuple(f"plan {i}" for i in range(6)) + ("plan|6",)
_PACKED = f"txt{packed.SUFFIX}"
_CSV = {"escape": '"', "quote": '"'}

_paths: dict[tuple[str, str, str], list[str]] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write, depth: int = 1, suffix: str = "txt") -> list[str]:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _paths:
        folder = scratch_path(spark, label)
        write(folder)
        _paths[key] = sorted(r["path"] for r in list_files(spark, [f"{folder}{'/*' * depth}/*.{suffix}"]).collect())
    return _paths[key]


def _stating(spark: SparkSession, sf_dir: str, n_files: int) -> DataFrame:
    """file, n_name, stated_day: the nation in whose name a file is stated, and the day of the month."""
    nations = star.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    numbered = spark.range(n_files).withColumnRenamed("id", "file")
    return numbered.join(nations, F.col("file") % 25 == F.col("n_nationkey")).select(
        "file", "n_name", (F.col("n_nationkey") % 9 + 1).cast("string").alias("stated_day")
    )


def _write_files(
    rows: DataFrame, text: Column, lead: Sequence[Column], tail: Sequence[Column], stating: DataFrame, n_files: int, folder: str
) -> None:
    """Write ``text`` of each row into ``n_files`` files, each between its lead and tail lines.

    The rows are dealt to the files as they are, and become text only where they are written; tasks write several files.
    Files are packed in a way that is still read in ranges, as their text is many times as large as the tables.
    """
    around = [(i, t) for i, t in enumerate(lead)] + [(len(lead) + 1 + i, t) for i, t in enumerate(tail)]
    framed = stating.select(
        "file", F.inline(F.array(*[F.struct(F.lit(i).alias("place"), t.alias("frame")) for i, t in around]))
    )
    body = rows.select("*", F.pmod(F.xxhash64(*rows.columns), F.lit(n_files)).alias("file"), F.lit(len(lead)).alias("place"))
    lines = (
        body.unionByName(framed, allowMissingColumns=True)
        .repartition(min(n_files, max(_FEW_FILES, n_files // _FILES_PER_TASK)), "file")
        .sortWithinPartitions("file", "place")
        .select("file", F.when(F.col("place") == len(lead), text).otherwise(F.col("frame")).alias("value"))
    )
    with shuffles_dropped(rows.sparkSession):
        lines.write.partitionBy("file").text(folder, compression="snappy")


def _n_files(spark: SparkSession, sf_dir: str) -> int:
    return star.table(spark, sf_dir, "lineitem").count() // ROWS_PER_FILE + 2


def _csv_line(columns: dict[str, Column]) -> Column:
    return F.to_csv(F.struct(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(columns.values())]), _CSV)


def _header(columns: Sequence[str]) -> str:
    return ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"') else c for c in columns)


def _csv_lead(columns: Sequence[str]) -> list[Column]:
    return [
        F.lit("\ufeffhospital_name,last_updated_on,version,,license_number|TN"),
        F.concat(F.lit('"General, ""Old"" Hospital of '), "n_name", F.lit('",2025-10-0'), "stated_day", F.lit(",2.0.0,ignored")),
        F.lit(_header(columns)),
    ]


def _rate_texts() -> tuple[Column, Column, Column]:
    """Dollar, percentage and algorithm text; some dollar text is not a number, some lines have no rate."""
    quantity = F.col("l_quantity")
    dollar = F.when(quantity >= 5, F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"))).when(
        quantity == 4, F.lit("12,5")
    )
    percentage = F.when(quantity == 3, F.col("l_discount").cast("string")).otherwise(F.lit("  "))
    algorithm = F.when(quantity == 2, F.lit("per contract"))
    return dollar, percentage, algorithm


def _slots() -> list[tuple[Column, Column]]:
    return [
        (F.col("p_type"), star.code_type(F.col("p_size"))),
        (F.col("p_brand"), F.lit("cdm")),
        (F.lit(" "), F.lit("CPT")),
        (F.when(F.col("p_size") % 4 == 0, F.col("p_type")), F.lit("hcpcs")),
    ]


def _item_columns(slots: int, odd_text: bool) -> dict[str, Column]:
    name = F.col("p_name")
    odd = F.concat(name, F.lit(', "large"\nsize '), F.col("p_size").cast("string"))
    columns = {"description": F.when(F.col("p_size") % 10 == 0, odd).otherwise(name) if odd_text else name}
    for i, (code, kind) in enumerate(_slots()[:slots], 1):
        columns[f"code|{i}"], columns[f"code|{i}|type"] = code, kind
    columns["modifiers"] = F.when(F.col("l_linenumber") > 5, F.lit(" 52 ")).otherwise(F.lit(" "))
    columns["setting"] = F.col("l_returnflag")
    columns["standard_charge|gross"] = F.col("l_extendedprice")
    columns["standard_charge|min"] = F.when(F.col("l_tax") > 0.01, F.col("l_tax").cast("string")).otherwise(F.lit("N/A"))
    columns["standard_charge|max"] = F.col("l_quantity")
    return columns


def tall_csv(spark: SparkSession, sf_dir: str, slots: int) -> list[str]:
    """Tall CSV files of all line items; with four slots they also hold quoted newlines and a billing class."""
    full = slots == 4

    def write(folder: str) -> None:
        dollar, percentage, algorithm = _rate_texts()
        columns = _item_columns(slots, odd_text=full)
        if full:
            columns["billing_class"] = F.col("l_linestatus")
        columns |= {
            "payer_name": F.col("c_mktsegment"),
            "plan_name": F.concat(F.lit("plan "), (F.col("c_custkey") % 7).cast("string")),
            "standard_charge|negotiated_dollar": dollar,
            "standard_charge|negotiated_percentage": percentage,
            "standard_charge|negotiated_algorithm": algorithm,
            "standard_charge|methodology": F.lit("fee schedule"),
            "": F.lit(None),
        }
        rows, n_files = star.written_lines(spark, sf_dir), _n_files(spark, sf_dir)
        _write_files(rows, _csv_line(columns), _csv_lead(list(columns)), [], _stating(spark, sf_dir, n_files), n_files, folder)

    return _once(spark, sf_dir, f"tall-{slots}", write, suffix=_PACKED)


def _wide_groups() -> list[tuple[str, int, dict[str, Column]]]:
    """segment, plan number and the cells of each payer/plan column set, in the order of the columns."""
    dollar, percentage, algorithm = _rate_texts()
    groups = []
    for segment in SEGMENTS:
        for k, plan in enumerate(PLANS):
            named = {"negotiated_dollar": dollar, "negotiated_percentage": percentage,
                     "negotiated_algorithm": algorithm, "methodology": F.lit(" case rate ")}
            if segment == "BUILDING":
                del named["methodology"]
            groups.append((segment, k, {f"standard_charge|{segment}'s|{plan}|{metric}": value for metric, value in named.items()}))
    return groups


def _wide_line(items: dict[str, Column], groups: Sequence[tuple[str, int, dict[str, Column]]]) -> Column:
    """A wide line: the item's cells, then one filled column set between the commas of the empty ones."""
    n_cells = sum(len(cells) for _, _, cells in groups)
    sets, before = F.lit("," * n_cells), 0
    texts = {len(cells): _csv_line(cells) for _, _, cells in groups}
    for segment in SEGMENTS:
        own = [cells for s, _, cells in groups if s == segment]
        width, plan = len(own[0]), F.col("c_custkey") % len(own)
        filled = F.concat(
            F.repeat(F.lit(","), (F.lit(before + 1) + plan * width).cast("int")), texts[width],
            F.repeat(F.lit(","), (F.lit(n_cells - before - width) - plan * width).cast("int")),
        )
        sets = F.when((F.col("c_mktsegment") == segment) & (plan >= 0), filled).otherwise(sets)
        before += width * len(own)
    return F.concat(_csv_line(items), sets)


def wide_csv(spark: SparkSession, sf_dir: str) -> list[str]:
    """Wide CSV files of all line items: 35 payer/plan column sets, one filled per line."""
    def write(folder: str) -> None:
        items = _item_columns(4, odd_text=False) | {"billing_class": F.col("l_linestatus")}
        groups = _wide_groups()
        names = [*items, *[name for _, _, cells in groups for name in cells]]
        rows, n_files = star.written_lines(spark, sf_dir), _n_files(spark, sf_dir)
        _write_files(rows, _wide_line(items, groups), _csv_lead(names), [], _stating(spark, sf_dir, n_files), n_files, folder)

    return _once(spark, sf_dir, "wide", write, suffix=_PACKED)


def price_json(spark: SparkSession, sf_dir: str) -> list[str]:
    """JSON documents of all line items: one item each, with repeated, missing and blank parts."""
    def write(folder: str) -> None:
        code = F.struct(F.col("p_type").alias("code"), star.code_type(F.col("p_size")).alias("type"))
        brand = F.struct(F.col("p_brand").alias("code"), F.lit("CDM").alias("type"))
        codes = F.when(F.col("p_size") % 11 > 0, F.array(code, brand, code))
        payer = F.struct(
            F.col("c_mktsegment").alias("payer_name"),
            F.concat(F.lit("plan "), (F.col("c_custkey") % 7).cast("string")).alias("plan_name"),
            F.when(F.col("l_quantity") >= 5, F.col("l_extendedprice")).alias("standard_charge_dollar"),
            F.when(F.col("l_quantity") == 3, F.col("l_discount").cast("string")).alias("standard_charge_percentage"),
            F.when(F.col("l_quantity") == 2, F.lit("per contract")).alias("standard_charge_algorithm"),
            F.when(F.col("l_quantity") == 2, F.col("l_tax")).alias("estimated_amount"),
            F.lit("fee schedule").alias("methodology"),
        )
        charges = F.array(
            F.struct(
                F.col("l_returnflag").alias("setting"), F.col("l_linestatus").alias("billing_class"),
                F.col("l_extendedprice").alias("gross_charge"), F.col("l_tax").alias("minimum"),
                F.array(payer).alias("payers_information"),
            ),
            F.struct(
                F.lit("no payers").alias("setting"), F.lit(None).cast("string").alias("billing_class"),
                F.lit(None).cast("double").alias("gross_charge"), F.lit(None).cast("double").alias("minimum"),
                F.when(F.col("l_linenumber") == 1, F.array(payer)).alias("payers_information"),
            ),
        )
        item = F.to_json(F.struct(
            F.col("p_name").alias("description"), codes.alias("code_information"), charges.alias("standard_charges")
        ))
        lead = [
            F.concat(
                F.lit('{"hospital_name":"General Hospital of '), "n_name", F.lit('","last_updated_on":"10/'), "stated_day",
                F.lit('/2025","affirmation":{"ok":true},'),
            ),
            F.lit('"standard_charge_information":[{"description":"no codes"}'),
        ]
        rows, n_files = star.written_lines(spark, sf_dir), _n_files(spark, sf_dir)
        _write_files(rows, F.concat(F.lit(","), item), lead, [F.lit("]}")], _stating(spark, sf_dir, n_files), n_files, folder)

    return _once(spark, sf_dir, "json", write, suffix=_PACKED)


def customer_pages(spark: SparkSession, sf_dir: str, run_id: str) -> list[str]:
    """Customers as JSON-array pages of bounded size."""
    def write(folder: str) -> None:
        page = F.floor(F.col("c_custkey") / ROWS_PER_PAGE)
        row = F.struct("c_custkey", F.col("c_name").alias("facility name"), "c_acctbal", "c_mktsegment")
        pages = star.table(spark, sf_dir, "customer").groupBy(page.alias("page")).agg(
            F.to_json(F.sort_array(F.collect_list(row))).alias("value")
        )
        pages.repartition(8, "page").write.partitionBy("page").text(folder)

    return _once(spark, sf_dir, f"pages-{run_id}", write)


ROWS_PER_SMALL_FILE = 100
_SMALL_FILES_PER_TASK = 64


def _small_file_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file and the whole text of a small price file per hundred customers; every seventh names another hospital."""
    file = F.floor(F.col("c_custkey") / ROWS_PER_SMALL_FILE)
    line = F.concat_ws(",", "c_name", "c_mktsegment", F.col("c_custkey").cast("string"))
    named = F.when(F.col("file") % 7 == 6, F.lit("Lakeview Campus")).otherwise(F.lit("Riverside Campus"))
    lead = F.concat(F.lit("hospital_name,version\n"), named, F.lit(",2.0.0\ndescription,code|1,standard_charge|gross\n"))
    lines = star.table(spark, sf_dir, "customer").groupBy(file.alias("file")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines")
    )
    return lines.select("file", F.concat(lead, "lines").alias("value"))


def small_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Those files as written."""
    def write(folder: str) -> None:
        n_files = star.table(spark, sf_dir, "customer").count() // ROWS_PER_SMALL_FILE + 1
        texts = _small_file_texts(spark, sf_dir).repartition(max(8, n_files // _SMALL_FILES_PER_TASK), "file")
        # Tasks move their files into place themselves; the driver would move all of them one after another.
        texts.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("file").text(folder)

    return _once(spark, sf_dir, "small", write)


def small_file_log(spark: SparkSession, sf_dir: str, paths: Sequence[str]) -> DataFrame:
    """A load log of the small files from the customers themselves, with faults by the file's number modulo 7.

    1 a wrong size, 2 a wrong hash, 3 a file that is gone, 4 two terminal events, 5 a failure and no start; every
    fourteenth file was skipped.
    """
    folder = paths[0].split("/file=")[0]
    names = spark.createDataFrame([(int(p.split("/file=")[1].split("/")[0]), p) for p in paths], "_file bigint, path string")
    written = F.concat("value", F.lit("\n"))
    texts = _small_file_texts(spark, sf_dir).join(names, F.col("file") == F.col("_file"))
    fault = F.col("file") % 7
    event = lambda status, size, digest: F.struct(
        status.alias("status"), size.cast("bigint").alias("file_bytes"), digest.cast("string").alias("sha256"))
    size = F.octet_length(written) + F.when(fault == 1, 1).otherwise(0)
    digest = F.when(fault == 2, F.sha2("value", 256)).otherwise(F.sha2(written, 256))
    done = event(F.when(F.col("file") % 14 == 7, F.lit("skipped")).otherwise(F.lit("succeeded")), size, digest)
    plain = lambda status: event(F.lit(status), F.lit(None), F.lit(None))
    events = (
        F.when(fault == 4, F.array(plain("started"), done, done)).when(fault == 5, F.array(plain("failed"), done))
        .otherwise(F.array(plain("started"), done))
    )
    return texts.select(
        F.lit("r").alias("run_id"), F.concat(F.lit("f"), F.col("file").cast("string")).alias("dataset_key"),
        F.lit("hospital_price_file").alias("source"), F.inline(events),
        F.when(fault == 3, F.lit(f"{folder}/gone.txt")).otherwise(F.col("path")).alias("landing_path"),
        F.to_timestamp(F.lit("2025-01-01")).alias("event_ts"),
    )


def faulty_page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log of two sets of customer pages, counted from the customers themselves, with faults by the page's number.

    Set a: no start, failures on even pages, two rows too many on every third. Set b: numbers with gaps, every third page
    unlogged, every fourth gone.
    """
    page = F.floor(F.col("c_custkey") / ROWS_PER_PAGE)
    counted = star.table(spark, sf_dir, "customer").groupBy(page.alias("page")).agg(F.count("*").alias("n"))
    frames = []
    for key in ("a", "b"):
        paths = customer_pages(spark, sf_dir, f"run-{key}")
        found = spark.createDataFrame([(int(p.split("/page=")[1].split("/")[0]), p) for p in paths], "_page bigint, path string")
        pages = counted.join(found, F.col("page") == F.col("_page"))
        if key == "a":
            number, path = F.col("page"), F.col("path")
            n = F.col("n") + F.when(F.col("page") % 3 == 1, 2).otherwise(0)
            failed = pages.where(F.col("page") % 2 == 0).select(F.lit("failed").alias("status"), F.lit(None).alias("number"), F.lit(None).alias("n"), "path")
        else:
            pages = pages.where(F.col("page") % 3 != 2)
            number, n = F.col("page") * 2, F.col("n")
            path = F.when(F.col("page") % 4 == 1, F.concat("path", F.lit(".gone"))).otherwise(F.col("path"))
            failed = spark.createDataFrame([("started",)], "status string").select("status", F.lit(None).alias("number"), F.lit(None).alias("n"), F.lit(None).alias("path"))
        landed = pages.select(F.lit("succeeded").alias("status"), number.alias("number"), n.alias("n"), path.alias("path"))
        frames.append(landed.unionByName(failed).withColumn("dataset_key", F.lit(key)))
    log = frames[0].unionByName(frames[1])
    return log.select(
        F.lit("r").alias("run_id"), "dataset_key", F.lit("catalog").alias("source"), F.col("number").cast("int").alias("page_number"),
        F.col("n").cast("int").alias("row_count"), "status", F.col("path").alias("landing_path"), F.to_timestamp(F.lit("2025-01-01")).alias("event_ts"),
    )


def dated_pages(spark: SparkSession, sf_dir: str) -> str:
    """Customers as JSON-array pages of five runs, one folder per date; returns the folder above them."""
    def write(folder: str) -> None:
        page = F.floor(F.col("c_custkey") / ROWS_PER_PAGE)
        date = F.concat(F.lit("2025-01-0"), (F.col("c_custkey") % 5 + 1).cast("string"))
        # A field that only some customers have.
        item = F.struct("c_custkey", "c_name", F.when(F.col("c_nationkey") > 12, F.col("c_acctbal")).alias("balance"))
        pages = star.table(spark, sf_dir, "customer").groupBy(date.alias("run_date"), page.alias("page")).agg(
            F.to_json(F.sort_array(F.collect_list(item))).alias("value")
        )
        pages.repartition(8, "run_date", "page").write.partitionBy("run_date", "page").text(folder)

    return _once(spark, sf_dir, "dated", write, depth=2)[0].split("/run_date=")[0]


def seed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Parts as a seed file with a header line; names hold commas and quotes."""
    def write(folder: str) -> None:
        name = F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"'))
        seeds = star.table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), "p_size", "p_retailprice")
        seeds.write.option("header", True).option("escape", '"').csv(f"{folder}/seed")

    return _once(spark, sf_dir, "seed", write, suffix="csv")[0].rsplit("/", 1)[0]


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log with two runs over the customer pages: an older one, then the newest."""
    from ratescope.plans.quality import page_contents

    frames = []
    for hour, run in enumerate(("run-a", "run-b")):
        facts = page_contents(spark, customer_pages(spark, sf_dir, run))
        frames.append(facts.select(
            F.lit(run).alias("run_id"), F.lit("customers").alias("dataset_key"), F.lit("catalog").alias("source"),
            F.regexp_extract("path", "page=(\\d+)", 1).cast("int").alias("page_number"),
            F.col("n_rows").cast("int").alias("row_count"), F.lit("succeeded").alias("status"),
            F.lit(None).cast("string").alias("error_message"), F.col("path").alias("landing_path"),
            F.to_timestamp(F.lit(f"2025-01-01 0{hour}:00:00")).alias("event_ts"),
        ))
        frames.append(spark.createDataFrame([(run,)], "run_id string").select(
            "run_id", F.lit("customers").alias("dataset_key"), F.lit("catalog").alias("source"),
            F.lit(None).cast("int").alias("page_number"), F.lit(None).cast("int").alias("row_count"),
            F.lit("started").alias("status"), F.lit(None).cast("string").alias("error_message"),
            F.lit(None).cast("string").alias("landing_path"),
            F.to_timestamp(F.lit(f"2025-01-01 0{hour}:30:00")).alias("event_ts"),
        ))
    log = frames[0]
    for f in frames[1:]:
        log = log.unionByName(f)
    return log.select(*[
        F.col(f.name) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MANIFEST.fields
    ])


def event_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a load log: users are dataset keys, event types are statuses."""
    kind = F.col("event_type")
    n = F.get_json_object("props", "$.k").cast("int")
    file_source = F.col("user_id") % 2 == 0
    return star.table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.floor(F.col("event_id") / 200).cast("string")).alias("run_id"),
        F.concat(F.lit("key-"), F.col("user_id").cast("string")).alias("dataset_key"),
        F.when(file_source, F.lit("hospital_price_file")).otherwise(F.lit("provider_data_catalog")).alias("source"),
        F.when(~file_source & kind.isin("view", "purchase"), (F.col("event_id") % 5).cast("int")).alias("page_number"),
        F.when(kind == "view", n).alias("row_count"),
        F.when(kind.isin("view", "purchase"), F.lit("succeeded"))
        .when(kind == "signup", F.lit("started"))
        .when(kind == "error", F.lit("failed"))
        .otherwise(F.lit("skipped"))
        .alias("status"),
        F.when(kind == "error", F.lit("timed out")).alias("error_message"),
        F.concat(F.lit("/landing/run_id=r"), F.col("event_id").cast("string"), F.lit("/f.csv")).alias("landing_path"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.when(kind != "view", F.col("event_id") * 10).alias("file_bytes"),
        F.lit(None).cast("string").alias("sha256"),
        F.when(n % 3 == 0, F.concat(F.lit("e"), (n % 4).cast("string"))).alias("etag"),
        F.when(n % 3 == 1, F.lit("Wed, 10 Jan 2024 10:00:00 GMT")).alias("last_modified"),
        F.lit(None).cast("string").alias("note"),
    )


