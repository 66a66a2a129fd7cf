import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from revlake.operators import ingest
from revlake.plans import load_invoices
from revlake.plans.load_invoices import ingest_batch, ledger_table
from revlake.schemas import ALIASES
from revlake.session import drop_intermediates, pinned, shared_dir
from revlake.sources import invoices as src
from revlake.streaming.invoices import bounded_dedupe, ingest_stream


def record(i=1, **change):
    base = {"invoice": f"I{i}", "country": "France", "customer_id": 7, "stream_id": "85", "price": 2.5, "times_viewed": 3, "year": 2019, "month": 1, "day": 5}
    base.update(change)
    return {k: v for k, v in base.items() if v != "drop"}


FILES = {
    "a.json": [record(1), record(2, customer_id=None)],
    "b.json": [record(3, stream_id="drop", StreamID="86", price="drop", total_price=4, times_viewed="drop", TimesViewed=9)],
    "c.json": [record(1), record(4, times_viewed="drop", year="2019", month="02", day="7")],
    "d.json": [record(5, country="drop"), record(6, month=2, day=30), record(7, price="drop"), record(8, price="n/a")],
    "single.json": record(9),
}


def put(folder, names=None):
    for name, content in FILES.items():
        if names is None or name in names:
            (folder / name).write_text(json.dumps(content))
    if names is None:
        (folder / "broken.json").write_text('[{"invoice": "x", ')


@pytest.fixture
def folders(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    return source, str(tmp_path / "base"), str(tmp_path / "state")


def stored(spark, base):
    return src.read_invoice_table(spark, f"{base}/invoices")


def test_batch_ingest(spark, folders):
    source, base, _ = folders
    put(source)
    summary = ingest_batch(spark, str(source), base).first().asDict()
    assert summary["files_processed"] == 6 and summary["status"] == "completed" and summary["records"] == 5
    rows = {r["invoice"]: r for r in stored(spark, base).collect()}
    assert sorted(rows) == ["I1", "I2", "I3", "I4"]
    assert rows["I1"]["source_file"] == "a.json" and rows["I2"]["customer_id"] is None
    assert (rows["I3"]["stream_id"], rows["I3"]["price"], rows["I3"]["times_viewed"]) == ("86", 4.0, 9)
    assert rows["I4"]["times_viewed"] == 0 and str(rows["I4"]["date"]) == "2019-02-07"
    reasons = {(r["source_file"], r["reject_reason"]) for r in spark.read.parquet(f"{base}/rejects").collect()}
    assert reasons == {
        ("d.json", "missing: country"), ("d.json", "not a calendar date"), ("d.json", "missing: price"), ("d.json", "price is not a number"),
        ("single.json", "top level is not an array"), ("broken.json", "unreadable JSON"),
    }
    ledger = {r["file_name"]: r for r in ledger_table(spark, base).collect()}
    assert ledger["a.json"]["processing_status"] == "completed" and ledger["a.json"]["records_processed"] == 2
    assert ledger["broken.json"]["processing_status"] == "failed" and ledger["single.json"]["processing_status"] == "failed"
    assert ledger["a.json"]["file_size"] == (source / "a.json").stat().st_size


def test_second_run_takes_only_new_files_and_force_adds_no_copies(spark, folders):
    source, base, _ = folders
    put(source, ["a.json"])
    ingest_batch(spark, str(source), base)
    assert ingest_batch(spark, str(source), base).first()["status"] == "no_files"
    put(source, ["c.json"])
    assert ingest_batch(spark, str(source), base).first()["files_processed"] == 1
    assert stored(spark, base).count() == 3
    assert ingest_batch(spark, str(source), base, force=True).first()["files_processed"] == 2
    assert stored(spark, base).count() == 3
    assert src.latest_ledger(ledger_table(spark, base)).count() == 2


def everything(spark, base):
    """All rows of the tables that a batch writes, without the commit log."""
    rejects = spark.read.parquet(f"{base}/rejects")
    return [sorted(map(repr, t.collect())) for t in (stored(spark, base), rejects, ledger_table(spark, base))]


def test_repeated_batches_change_nothing(spark, folders, monkeypatch):
    source, base, state = folders
    put(source)
    (source / "empty.json").write_text(" []")
    first = ingest_batch(spark, str(source), base, key="one").first()
    before = everything(spark, base)
    assert (first["files_processed"], first["errors"]) == (7, 6)
    assert ingest_batch(spark, str(source), base, force=True, key="one").first() == first  # in the log
    assert ingest_batch(spark, str(source), base, force=True).first()["records"] == 5
    ingest_stream(spark, str(source), base, state).awaitTermination()
    assert everything(spark, base) == before
    assert {r["file_name"]: r["records_processed"] for r in ledger_table(spark, base).collect()}["empty.json"] == 0

    # A batch that breaks off after its invoices is made whole by its repetition.
    def broken(*_):
        raise RuntimeError("lost")

    other = base + "-other"
    with monkeypatch.context() as m:
        m.setattr(load_invoices, "new_rejects", broken)
        with pytest.raises(RuntimeError):
            ingest_batch(spark, str(source), other, key="two")
    assert stored(spark, other).count() == 4
    ingest_batch(spark, str(source), other, key="two")
    key = ["invoice", "price", "source_file"]
    assert sorted(map(tuple, stored(spark, other).select(key).collect())) == sorted(map(tuple, stored(spark, base).select(key).collect()))
    assert spark.read.parquet(f"{other}/rejects").count() == spark.read.parquet(f"{base}/rejects").count()


def test_stages_are_removed_and_files_are_read_once(spark, folders):
    source, base, _ = folders
    put(source)
    plan = src.read_invoices(spark, str(source))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and "Exchange" not in plan
    ingest_batch(spark, str(source), base)
    folder = Path(shared_dir(spark).removeprefix("file:")) / "revlake" / spark.sparkContext.applicationId
    assert not list(folder.glob("parsed-*"))


def test_odd_files(spark, tmp_path):
    texts = {"bom.json": "\ufeff" + json.dumps([record(1)]), "blank.json": " \n", "empty.json": "[ ]", "text.json": "hello", "null.json": "null", "number.json": "[1]"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = {r["source_file"]: r for r in src.read_invoices(spark, str(tmp_path)).collect()}
    assert "empty.json" not in rows and rows["bom.json"]["invoice"] == "I1"
    assert {n: rows[n]["file_error"] for n in rows} == {
        "bom.json": None, "blank.json": "unreadable JSON", "text.json": "top level is not an array",
        "null.json": "top level is not an array", "number.json": "unreadable JSON",
    }


def test_stream_equals_batch_and_adds_nothing_twice(spark, folders, tmp_path):
    source, base, state = folders
    put(source)
    ingest_stream(spark, str(source), base, state, files_per_batch=2).awaitTermination()
    batch = str(tmp_path / "batch")
    ingest_batch(spark, str(source), batch)
    key = ["invoice", "stream_id", "price", "date"]
    assert sorted(map(tuple, stored(spark, base).select(key).collect())) == sorted(map(tuple, stored(spark, batch).select(key).collect()))
    ingest_stream(spark, str(source), base, state).awaitTermination()
    ingest_stream(spark, str(source), base, str(tmp_path / "fresh")).awaitTermination()
    assert stored(spark, base).count() == 4
    rejects = spark.read.parquet(f"{base}/rejects").where("source_file = 'single.json'").collect()
    assert rejects[0]["reject_reason"] == "top level is not an array"


def test_bounded_dedupe_stream(spark, folders):
    source, base, state = folders
    rows = spark.range(20).select(F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"), F.md5((F.col("id") % 4).cast("string")).alias("record_hash"))
    rows.write.parquet(f"{base}/in")
    stream = bounded_dedupe(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), "ts")
    query = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 4


def test_hash_keeps_fields_apart_and_ignores_country(spark):
    rows = [record(1, customer_id="1", times_viewed=None), record(1, customer_id=None, times_viewed="1"), record(1, customer_id="1", times_viewed=None, country="Spain")]
    raw = spark.createDataFrame([{k: None if r.get(k) is None else str(r[k]) for k in ALIASES} for r in rows], ", ".join(f"{k} string" for k in ALIASES))
    hashes = [r["record_hash"] for r in ingest.parse_records(raw).collect()]
    assert len(set(hashes)) == 2


def test_check_columns(spark):
    good = spark.createDataFrame([tuple("x" * 9)], "invoice string, country string, customer_id string, StreamID string, total_price string, TimesViewed string, year string, month string, day string")
    assert set(ingest.check_columns(good).columns) == set(ALIASES)
    with pytest.raises(ValueError, match="do not match"):
        ingest.check_columns(good.drop("day"))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("all", "2019-01-01", 1.5), ("france", "2019-01-01", 2.5)], "series string, date string, revenue double")
    src.write_series_csv(df, str(tmp_path / "series"))
    back = src.read_series_csv(spark, str(tmp_path / "series"), "date string, revenue double, series string")
    assert sorted(map(tuple, back.select("series", "date", "revenue").collect())) == sorted(map(tuple, df.collect()))
    src.write_csv(df, str(tmp_path / "flat"))
    assert src.read_csv(spark, str(tmp_path / "flat"), df.schema).count() == 2


def test_history_and_baseline_files(spark, tmp_path):
    history = {"France_arima": [{"r2": 0.9, "mae": 1.0, "timestamp": "2024-01-01T00:00:00", "country": "France", "model_type": "arima"}]}
    (tmp_path / "h.json").write_text(json.dumps(history))
    row = src.read_metrics_history(spark, str(tmp_path / "h.json")).first()
    assert (row["key"], row["r2"], row["country"]) == ("France_arima", 0.9, "France")
    (tmp_path / "b.json").write_text(json.dumps({"price": {"mean": 2.0, "std": 1.0}}))
    assert {r["stat"]: r["value"] for r in src.read_baseline_stats(spark, str(tmp_path / "b.json")).collect()} == {"mean": 2.0, "std": 1.0}
    src.save_report(spark.range(2), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_unknown_country_is_marked(spark):
    df = spark.createDataFrame([("uk",), (" holland ",), ("Atlantis",)], "country string")
    assert [tuple(r) for r in ingest.normalize_country(df).orderBy("country").collect()] == [("Atlantis", False), ("Netherlands", True), ("United Kingdom", True)]
    assert ingest.select_countries(ingest.normalize_country(df)).count() == 2


def test_intermediates_can_be_dropped(spark):
    kept = pinned(spark.range(3), "probe")
    path = kept.inputFiles()[0]
    assert src.table_exists(spark, path)
    drop_intermediates(spark)
    assert not src.table_exists(spark, path)


class Unset:
    """A session without the setting."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")


def test_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    assert shared_dir(Unset("local[2]")) == shared_dir(Unset("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Unset("yarn"))


def test_a_repetition_moves_no_rows(spark, folders, monkeypatch):
    """A forced batch compares hashes; without new ones nothing is written, with one only its month."""
    source, base, _ = folders
    put(source)
    ingest_batch(spark, str(source), base)
    before = sorted(map(tuple, stored(spark, base).collect()))
    written = []
    monkeypatch.setattr(load_invoices, "write_invoices", lambda df, path: written.append(df.count()) or src.write_invoices(df, path))
    ingest_batch(spark, str(source), base, force=True)
    assert written == [] and sorted(map(tuple, stored(spark, base).collect())) == before
    (source / "later.json").write_text(json.dumps([record(1), record(77), record(77)]))
    ingest_batch(spark, str(source), base)
    assert written == [1] and stored(spark, base).count() == len(before) + 1


def test_a_large_batch_is_merged_by_groups_of_months(spark, folders, monkeypatch):
    source, base, _ = folders
    rows = [record(i % 30, month=1 + i % 5, country="France" if i < 45 else "Spain") for i in range(60)]
    (source / "a.json").write_text(json.dumps(rows))
    (source / "b.json").write_text(json.dumps(rows[:20]))
    expected = sorted({(f"I{i % 30}", 1 + i % 5) for i in range(60)})
    written = []
    monkeypatch.setattr(load_invoices, "AT_ONCE", 33)
    monkeypatch.setattr(load_invoices, "write_invoices", lambda df, path: written.append(df.count()) or src.write_invoices(df, path))
    for force in (False, True):
        ingest_batch(spark, str(source), base, force)
        assert written == [12, 12, 6]
        assert sorted((r["invoice"], r["month"]) for r in stored(spark, base).collect()) == expected


def test_invoice_files_lie_in_one_folder(spark, sf):
    from checks import ingest as queries

    folder = Path(queries.invoice_folder(spark, sf, per_file=500))
    files = [p for p in folder.iterdir() if p.name.endswith(".txt") and p.stat().st_size]
    assert not [p for p in folder.iterdir() if p.is_dir()] and len(files) > 3
    assert src.read_invoices(spark, str(folder), "*.txt").where("file_error is null").count() == queries.raw_records(spark, sf).count()
