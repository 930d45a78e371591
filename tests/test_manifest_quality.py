import pandas as pd
import hashlib
import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ratescope import schemas
from ratescope.plans import manifest, quality
from tests import fixtures as fx

T0 = datetime(2026, 1, 10, 12)
FIELDS = [f.name for f in schemas.MANIFEST.fields]


def log(spark, *events):
    base = dict.fromkeys(FIELDS) | {"run_id": "r", "source": schemas.PRICE_FILE_SOURCE, "status": "succeeded", "event_ts": T0}
    return spark.createDataFrame([tuple({**base, **e}[f] for f in FIELDS) for e in events], schemas.MANIFEST)


def test_last_download_ignores_skips(spark):
    df = log(
        spark,
        {"dataset_key": "a", "landing_path": "old"},
        {"dataset_key": "a", "landing_path": "new", "event_ts": T0 + timedelta(days=1)},
        {"dataset_key": "a", "landing_path": "skip", "status": "skipped", "event_ts": T0 + timedelta(days=2)},
        {"dataset_key": "b", "landing_path": "x", "status": "failed"},
    )
    assert [(r["dataset_key"], r["landing_path"]) for r in manifest.last_downloads(df).collect()] == [("a", "new")]


def test_every_refresh_decision(spark):
    date = "Sat, 10 Jan 2026 11:00:00 GMT"
    late = "Sun, 11 Jan 2026 11:00:00 +0000"
    prev = {"landing_path": "p", "file_bytes": 5}
    cases = {  # key: (earlier download, what is seen now, skip, reason)
        "forced": (prev, {"forced": True}, False, "force_download is on"),
        "first": (None, {}, False, "no earlier successful download"),
        "gone": (prev, {"disk_bytes": None}, False, "earlier file is missing or its size changed on disk"),
        "resized": (prev, {"disk_bytes": 6}, False, "earlier file is missing or its size changed on disk"),
        "old": (prev | {"event_ts": T0 - timedelta(days=40)}, {}, False, "earlier download is over 30 days old; refreshing"),
        "no_headers": (prev, {"headers_read": False}, False, "could not read headers from the server"),
        "etag_same": (prev | {"etag": "e"}, {"etag": "e", "last_modified": late}, True, "ETag unchanged"),
        "etag_new": (prev | {"etag": "e"}, {"etag": "f"}, False, "ETag changed"),
        "lm_same": (prev | {"last_modified": date}, {"last_modified": date, "etag": "x"}, True, "Last-Modified unchanged"),
        "lm_new": (prev | {"last_modified": date}, {"last_modified": late}, False, "Last-Modified changed"),
        "older": (prev, {"last_modified": date}, True, "not modified since the last download"),
        "older_size": (prev, {"last_modified": date, "content_length": "5"}, True, "not modified since the last download"),
        "size_differs": (prev, {"last_modified": date, "content_length": "7"}, False, "modified after the last download, or the size differs"),
        "newer": (prev, {"last_modified": late}, False, "modified after the last download, or the size differs"),
        "bad_date": (prev, {"last_modified": "yesterday"}, False, "server gave no reliable change signal"),
        "blank_etag": (prev | {"etag": ""}, {"etag": ""}, False, "server gave no reliable change signal"),
    }
    events = [{"dataset_key": k, **p} for k, (p, *_) in cases.items() if p is not None]
    seen = {"forced": False, "disk_bytes": 5, "headers_read": True, "etag": None, "last_modified": None, "content_length": None}
    observed = spark.createDataFrame(
        [(k, *{**seen, **now}.values()) for k, (_, now, _, _) in cases.items()],
        "dataset_key string, forced boolean, disk_bytes bigint, headers_read boolean, etag string, last_modified string, "
        "content_length string",
    )
    now = F.to_timestamp(F.lit("2026-01-12 00:00:00"))
    got = manifest.refresh_decisions(manifest.last_downloads(log(spark, *events)), observed, now).collect()
    assert {r["dataset_key"]: (r["skip"], r["reason"]) for r in got} == {k: c[2:] for k, c in cases.items()}


def statuses(df):
    return {r["check_name"]: r["status"] for r in df.collect()}


def page_log(spark, paths, counts, numbers=None, key="k"):
    numbers = numbers or range(len(paths))
    return log(
        spark, {"dataset_key": key, "status": "started"},
        *[{"dataset_key": key, "landing_path": p, "row_count": c, "page_number": n} for p, c, n in zip(paths, counts, numbers)],
    )


def run_page_checks(spark, df, folder, contents_of, min_rows=2, columns=("ID",)):
    listing = spark.read.format("binaryFile").load(f"{folder}/*.json").select("path")
    norm = lambda d: d.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    needs = spark.createDataFrame([("k", min_rows, list(columns))], "dataset_key string, min_rows bigint, required_columns array<string>")
    return statuses(quality.page_checks(df, "r", norm(listing), norm(quality.page_contents(spark, contents_of)), needs))


def test_page_checks(spark, tmp_path):
    good = [fx.write(tmp_path, f"good/p{i}.json", json.dumps([{"id": i}, {"id": 9}])) for i in (0, 1)]
    ok = run_page_checks(spark, page_log(spark, good, [2, 2]), tmp_path / "good", good)
    assert set(ok.values()) == {"pass"} and len(ok) == 10
    fx.write(tmp_path, "good/left_over.json", "[]")
    bad = run_page_checks(spark, page_log(spark, good, [2, 3], [1, 3]), tmp_path / "good", good, 9, ("id", "zip"))
    assert {k for k, v in bad.items() if v == "fail"} == {"pages_contiguous", "rows_reconcile", "min_rows", "required_columns"}
    assert bad["no_stale_files"] == "warn"
    odd = [fx.write(tmp_path, f"odd/p{i}.json", t) for i, t in enumerate(['{"id": 1}', "[1, 2]", "[{"])]
    for path in odd:
        found = run_page_checks(spark, page_log(spark, [path], [1]), tmp_path / "odd", [path])
        assert found["pages_parse"] == "fail" and "rows_reconcile" not in found
    gone = run_page_checks(spark, page_log(spark, [*good, "/nowhere.json"], [2, 2, 1]), tmp_path / "good", good)
    assert gone["files_exist"] == "fail" and "pages_parse" not in gone
    nothing = statuses(quality.page_checks(
        log(spark, {"dataset_key": "k", "status": "failed"}), "r",
        spark.createDataFrame([], "path string"),
        spark.createDataFrame([], "path string, n_rows bigint, n_corrupt bigint, columns array<string>"),
        spark.createDataFrame([], "dataset_key string, min_rows bigint, required_columns array<string>"),
    ))
    assert nothing == {"started_logged": "fail", "no_failed_events": "fail", "pages_landed": "fail"}


def test_file_checks(spark, tmp_path):
    texts = {
        "good": fx.TALL, "json": fx.price_json(), "html": "<!DOCTYPE html><p>sign in</p>", "tiny": "x", "twice": fx.TALL, "gone": fx.TALL,
    }
    paths = {k: fx.write(tmp_path, f"{k}.dat", t) for k, t in texts.items()}
    facts = quality.file_facts(spark, [p for k, p in paths.items() if k != "gone"]).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    events = []
    for key, path in paths.items():
        raw = texts[key].encode()
        done = {"dataset_key": key, "landing_path": path, "file_bytes": len(raw), "sha256": hashlib.sha256(raw).hexdigest()}
        if key == "tiny":
            done |= {"sha256": "0", "file_bytes": 2}
        events += [{"dataset_key": key, "status": "started"}, done] + ([done] if key == "twice" else [])
        if key == "json":
            events[-1]["status"] = "skipped"
    specs = spark.createDataFrame(
        [(k, "Old General Clinic" if k == "good" else "Saint Thomas", "json" if k == "json" else "csv", 10) for k in paths],
        "dataset_key string, hospital_name string, file_format string, min_bytes bigint",
    )
    found = {}
    for r in quality.file_checks(log(spark, *events), "r", facts, specs).collect():
        found.setdefault(r["subject"], {})[r["check_name"]] = r["status"]
    assert set(found["good"].values()) == {"pass"} and len(found["good"]) == 8
    assert found["json"]["download_or_skip"] == "pass" and found["json"]["hospital_name_in_file"] == "warn"
    assert found["html"]["format_looks_right"] == "warn" and found["html"]["size_matches_manifest"] == "pass"
    assert {k for k, v in found["tiny"].items() if v == "fail"} == {"size_matches_manifest", "min_bytes", "checksum_matches"}
    assert found["twice"]["one_succeeded_row"] == "fail" and found["gone"]["file_exists"] == "fail"
    saved, quality._HASH_BLOCK = quality._HASH_BLOCK, 7
    try:
        facts = next(quality._facts([pd.DataFrame({"path": [paths["good"]], "length": [1]})])).iloc[0]
    finally:
        quality._HASH_BLOCK = saved
    assert facts["sha256"] == hashlib.sha256(fx.TALL.encode()).hexdigest() and facts["head"].decode() == fx.TALL


def test_payload_heads(spark):
    cases = [
        ("csv", b"", "empty response body"),
        ("csv", b"\xef\xbb\xbf  <!DOCTYPE html>", "received an HTML page instead of a data file"),
        ("json", b"<HTML>", "received an HTML page instead of a data file"),
        ("json", b"hospital", "expected JSON but payload does not start with { or ["),
        ("json", b"\xef\xbb\xbf\n[1]", None), ("json", b"{", None), ("csv", b"a,b", None),
        ("zip", b"PK\x03\x04", None), ("zip", b"pk", "expected a zip archive but the file signature is missing"),
    ]
    df = spark.createDataFrame([(i, f, bytearray(h)) for i, (f, h, _) in enumerate(cases)], "i int, f string, h binary")
    got = [r[0] for r in df.orderBy("i").select(quality.head_problem(F.col("f"), F.col("h"))).collect()]
    assert got == [c[2] for c in cases]


def test_bad_row_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, None), (None, None)], "k string, v int")
    assert quality.null_rows(df, "v").count() == 3
    assert [tuple(r) for r in quality.repeated_values(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.repeated_combinations(df, ["k", "v"]).collect()] == [(None, None, 2)]
    assert quality.unaccepted_values(df, "k", ["b"]).collect()[0]["n_rows"] == 2
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    assert [tuple(r) for r in quality.orphans(df, "k", parent, "k").collect()] == [("a", 2)]
    result = quality.table_checks(df, "t", quality.not_null("v"))
    assert tuple(result.first()) == ("t", "not_null v", "fail", 3, "3 bad row(s)")
    try:
        quality.raise_on_failure(result)
    except quality.QualityError as error:
        assert str(error) == "t: not_null v (3 bad row(s))"
    else:
        raise AssertionError("no error")


def test_checks_of_a_table_share_its_scans(spark, tmp_path):
    rows = [("a", 1, -1.0), ("a", None, 2.0), (None, 1, None), (None, None, 0.0), (None, None, -5.0), ("b", 7, 1.0)]
    spark.createDataFrame(rows, "k string, v int, negotiated_dollar double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    parent = spark.createDataFrame([("b",), ("b",), (None,)], "p string")
    checks = [
        quality.not_null("k", "v"), quality.unique("k", "v"), quality.accepted("k", ["b"]), quality.accepted("v", [1, 7]),
        quality.unique_together(["k", "v"], quality.WARN), quality.unique_together(["v", "k"]), quality.no_negative("negotiated_dollar", "sign"),
    ]
    expected = {
        ("not_null k", "fail", 3), ("not_null v", "fail", 3), ("unique k", "fail", 1), ("unique v", "fail", 1), ("accepted_values k", "fail", 1),
        ("accepted_values v", "pass", 0), ("unique_combination", "warn", 1), ("unique_combination", "fail", 1), ("sign", "fail", 2),
    }
    found = quality.table_checks(df, "t", *checks)
    assert {(r["check_name"], r["status"], r["n_bad"]) for r in found.collect()} == expected and found.count() == 9
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2
    with_parent = quality.table_checks(df, "t", quality.related("k", parent, "p"), quality.unique("v")).collect()
    assert {(r["check_name"], r["status"], r["n_bad"]) for r in with_parent} == {("relationships k", "fail", 1), ("unique v", "fail", 1)}
    empty = quality.table_checks(df.where("false"), "t", *checks).collect()
    assert len(empty) == 9 and all(r["status"] == "pass" for r in empty)


def test_small_files_are_hashed_several_a_task(spark, tmp_path):
    paths = [fx.write(tmp_path, f"{i}.csv", f"hospital_name\n{i}\n") for i in range(40)]
    facts = quality.file_facts(spark, paths)
    assert facts.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert {r["length"] for r in facts.collect()} == {16, 17} and facts.select("sha256").distinct().count() == 40
