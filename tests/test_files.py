import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barledger.operators import artifacts, audit, deals, quality
from barledger.sources import deals as deal_files
from barledger.sources import evidence, tables
from barledger.sources.lines import data_records, located, split_fields
from barledger.streaming import landed

DAY, NEXT = date(2026, 9, 17), date(2026, 9, 18)
GOOD = "Date,Symbol,Quantity\n2026-09-17,CI_FIXTURE_ONLY,1\n"


def land(directory, kind="bulk", **files):
    for stamp, text in files.items():
        (directory / f"{kind}deals_{stamp[1:]}.csv").write_text(text)


def scan(spark, directory, start=DAY, end=NEXT, kind="bulk", **kwargs):
    rows, fetches = deal_files.scan_deals(spark, str(directory), kind, start, end, **kwargs)
    windows = spark.createDataFrame([("r", start, end)], "run_id string, start date, end date")
    ledger = deals.deals_ledger(windows, fetches.withColumn("run_id", F.lit("r")))
    family = deals.deals_coverage(ledger).where(F.col("kind") == kind).first()
    return rows, family


def test_successful_window(spark, tmp_path):
    land(tmp_path, _17Sep2026=GOOD, _18Sep2026=GOOD, _19Sep2026=GOOD)
    land(tmp_path, kind="block", _17Sep2026=GOOD)
    for hot_rows in (1, 1000):
        rows, family = scan(spark, tmp_path, hot_rows=hot_rows)
        assert rows.count() == 2 and family.success and family.rows == 2


def test_absent_day_is_unverified(spark, tmp_path):
    land(tmp_path, _18Sep2026=GOOD)
    rows, family = scan(spark, tmp_path)
    assert rows.count() == 1 and not family.success and (family.unverified, family.blocked) == (1, 0)


@pytest.mark.parametrize("text", ["<html>Access denied</html>", "Date,Name\n2026-09-17,X\n", GOOD + "a,b,c,d\n"])
def test_unusable_payload_blocks(spark, tmp_path, text):
    land(tmp_path, _17Sep2026=text, _18Sep2026=GOOD)
    rows, family = scan(spark, tmp_path)
    assert not family.success and family.blocked == 1 and family.not_attempted == 1
    assert rows.count() == 1


def test_header_only_window_is_not_success(spark, tmp_path):
    land(tmp_path, _17Sep2026="Date,Symbol,Quantity\n")
    _, family = scan(spark, tmp_path, end=DAY)
    assert family.observed == 1 and family.rows == 0 and not family.success


def test_each_file_keeps_its_own_header(spark, tmp_path):
    land(tmp_path, _17Sep2026=' SYMBOL ,date,Price,Client Name,Remarks\r\nA,17-SEP-2026,"1,234.50",x,"a ""b"", c"\r\n',
         _18Sep2026="Date,Symbol,Quantity,Quantity\n2026-09-18,B,5,6\n")
    rows = {r.symbol: r for r in scan(spark, tmp_path)[0].collect()}
    assert rows["A"].deal_date == DAY and float(rows["A"].price) == 1234.5 and rows["A"].quantity is None
    assert rows["A"].extras == {"Client Name": "x", "Remarks": 'a "b", c'}
    assert rows["B"].quantity == 5 and rows["B"].extras == {"Quantity.1": "6"}


def test_request_is_checked(spark, tmp_path):
    for arguments in [("other", DAY, NEXT), ("bulk", NEXT, DAY)]:
        with pytest.raises(ValueError):
            deal_files.scan_deals(spark, str(tmp_path), *arguments)
    start, end = deals.lookback(NEXT)
    assert (end - start).days + 1 == 91


def test_save_deals(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", _17Sep2026=GOOD + "2026-09-17,CI_FIXTURE_ONLY,1\n")
    rows, _ = scan(spark, tmp_path / "in")
    assert deal_files.save_deals(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert not deal_files.save_deals(rows.where("false"), str(tmp_path / "none"))


def test_blocked_bulk_family_stops_the_block_family(spark):
    windows = spark.createDataFrame([("r", DAY, NEXT)], "run_id string, start date, end date")
    fetches = [("r", "bulk", DAY, 429, True, 1), ("r", "bulk", NEXT, 200, True, 1), ("r", "block", DAY, 200, True, 1)]
    table = spark.createDataFrame(fetches, "run_id string, kind string, day date, status int, header_ok boolean, rows bigint")
    outcomes = [r.outcome for r in deals.deals_ledger(windows, table).orderBy("ordinal").collect()]
    assert outcomes == ["source_blocked", "not_attempted", "not_attempted", "not_attempted"]


def test_csv_missing_tokens_and_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\n1,1.5,x,N/A\n2,NaN,None,\n3,7,1d,null\n")
    table = tables.load_csv(spark, str(tmp_path / "t.csv"))
    assert dict(table.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "string"}
    assert [tuple(r) for r in table.orderBy("a").collect()] == [(1, 1.5, "x", None), (2, None, None, None), (3, 7.0, "1d", None)]
    typed = tables.load_csv(spark, str(tmp_path / "t.csv"), "a int, b double, d date")
    assert dict(typed.dtypes) == {"a": "int", "b": "double", "c": "string", "d": "date"}
    assert tables.load_csv(spark, str(tmp_path / "absent.csv")) is None


def test_catalog_and_analysis(spark, tmp_path):
    from barledger.operators import analytics

    (tmp_path / "nse_bhavcopy.csv").write_text("symbol,date,close\nX,2020-01-01,100\nX,2020-01-02,101\n")
    (tmp_path / "fundamentals.csv").write_text("symbol,market_cap\nX,1000000000\n")
    catalog = tables.load_catalog(spark, str(tmp_path))
    assert set(catalog) == {"bhavcopy", "fundamentals"}
    report = {(r.section, r.metric): r.value for r in analytics.summary_report(catalog).collect()}
    assert report[("bhavcopy", "records")] == "2" and report[("fundamentals", "records")] == "1"
    assert report[("bhavcopy", "last_date")] == "2020-01-02"
    assert analytics.price_change(catalog["bhavcopy"]).first().change_pct == 1.0
    assert analytics.top_market_cap(catalog["fundamentals"]).first().market_cap_billions == 1.0
    assert spark.sql("SELECT * FROM bhavcopy WHERE close > 100").count() == 1
    tables.save_csv(catalog["bhavcopy"], str(tmp_path / "out"))
    assert tables.load_csv(spark, str(tmp_path / "out")).count() == 2
    tables.save_table(catalog["bhavcopy"], "saved_prices", keys=("symbol",), buckets=2, mode="overwrite")
    assert tables.read_table(spark, "saved_prices").count() == 2


def test_cleaning_never_fills(spark):
    table = spark.createDataFrame([("A", 10.0), ("B", None), ("C", 30.0), ("C", 30.0)], "symbol string, cap double")
    cleaned = quality.clean_rows(table)
    assert cleaned.count() == 3 and cleaned.where("symbol = 'B'").first().cap is None
    facts = quality.validate_table(table).first()
    assert (facts.rows, facts.null_cells, facts.duplicate_rows, facts.valid) == (4, 1, 1, False)
    assert quality.validate_table(table.where("symbol = 'A'")).first().valid
    assert not quality.validate_table(table.where("false")).first().valid
    renamed = quality.standardize_columns(table, {"cap": "market_cap", "absent": "x"})
    assert renamed.columns == ["symbol", "market_cap"]
    both = quality.append_tables(table, table.withColumn("more", F.lit(1)).drop("cap"))
    assert both.columns == ["symbol", "cap", "more"] and both.count() == 8


def audited(spark):
    rows = [("r", "A.NS", i, datetime(2026, 9, 14 + i), 10.0, 12.0, 9.0, 11.0, 5.0, 1.0) for i in range(4)]
    rows.append(("r", "B.NS", 0, datetime(2026, 9, 14), None, 12.0, 9.0, 11.0, 5.0, 1.0))
    frame = spark.createDataFrame(rows, landed.FRAME_SCHEMA)
    return frame, audit.audit_rows(frame, date(2026, 9, 14), date(2026, 9, 19))


def test_bundle_is_committed_last_and_checked(spark, tmp_path):
    _, rows = audited(spark)
    root = str(tmp_path / "observation")
    assert not evidence.is_committed(spark, root)
    with pytest.raises(ValueError):
        evidence.read_bundle(spark, root)
    evidence.write_bundle(rows, root, {"run_attempt": "1", "retrieved_at_utc": "t"})
    assert evidence.is_committed(spark, root) and evidence.read_bundle(spark, root).count() == 5
    manifest = {r.symbol: r for r in spark.read.json(root + "/manifest").collect()}
    assert manifest["B.NS"].rejected_rows == 1 and manifest["A.NS"].usable_rows == 4
    assert spark.read.json(root + "/rejected").first().reasons == ["missing:Open"]
    assert {r.status for r in evidence.verify_bundle(spark, root).collect()} == {"verified"}
    files = {r.file: r.rows for r in spark.read.json(root + "/files").collect()}
    for part, rows_of in {"frame": 5, "rejected": 1}.items():
        assert sum(n for name, n in files.items() if name.startswith(part + "/")) == rows_of
    by_partition = {flag: sum(n for name, n in files.items() if f"accepted={flag}/" in name) for flag in ("true", "false")}
    assert by_partition == {"true": 4, "false": 1}
    assert any(name.startswith("positions/") for name in files)
    part = next((tmp_path / "observation" / "positions").glob("part-*"))
    part.with_name(f".{part.name}.crc").unlink()  # the local file system's own checksum
    part.write_bytes(part.read_bytes() + b" ")
    assert {r.status for r in evidence.verify_bundle(spark, root).collect()} == {"verified", "checksum_mismatch"}
    with pytest.raises(Exception):
        evidence.write_bundle(rows, root, {"run_attempt": "2"})


def test_half_written_manifest_is_no_commit(spark, tmp_path):
    _, rows = audited(spark)
    root = str(tmp_path / "observation")
    evidence.write_bundle(rows, root, {"run_attempt": "1", "retrieved_at_utc": "t"})
    (tmp_path / "observation" / "manifest" / "_SUCCESS").unlink()
    assert not evidence.is_committed(spark, root)
    with pytest.raises(ValueError):
        evidence.read_bundle(spark, root)


def test_published_prices_are_in_order(spark, tmp_path):
    _, rows = audited(spark)
    admitted = audit.admitted_rows(rows, audit.frame_verdicts(rows))
    published = audit.published_prices(admitted, provider_version="1", retrieved_at_utc="t")
    tables.save_prices(published, str(tmp_path / "prices"))
    stored = spark.read.parquet(str(tmp_path / "prices"))
    assert [r.date for r in stored.collect()] == [f"2026-09-{d}" for d in range(14, 18)]


def test_artifact_gate(spark):
    expected = spark.createDataFrame([("A", date(2026, 9, 14)), ("A", date(2026, 9, 15))], "symbol string, date date")

    def check(*rows):
        prices = spark.createDataFrame(list(rows), "symbol string, date date, source string, provider_symbol string")
        caps = spark.createDataFrame([("A", 1.0, "INR", "Infosys Ltd")], "symbol string, market_cap double, market_cap_currency string, name string")
        return artifacts.accept(
            artifacts.price_sample_checks(expected, prices, ["symbol"], F.lit("A.NS")),
            artifacts.snapshot_sample_checks(caps, ["symbol"], "infosys"), keys=["symbol"],
        ).first()

    good = [("A", date(2026, 9, d), "yahoo_finance", "A.NS") for d in (14, 15)]
    assert check(*good).accepted
    assert not check(good[0]).dates_match
    assert not check(*good, good[0]).count_matches
    assert not check(good[0], (*good[1][:2], "other", "A.NS")).provenance_matches


def test_dates_of_a_sample_are_compared_as_sets(spark):
    days = [date(1969, 12, 31), date(1970, 1, 1), date(1970, 3, 5), date(2026, 9, 14)]

    def check(wanted, found):
        expected = spark.createDataFrame([("A", d) for d in wanted], "symbol string, date date")
        prices = spark.createDataFrame(
            [("A", d, "yahoo_finance", "A.NS") for d in found], "symbol string, date date, source string, provider_symbol string"
        )
        row = artifacts.price_sample_checks(expected, prices, ["symbol"], F.lit("A.NS")).first()
        return row.dates_match, row.count_matches, row.provenance_matches

    assert check(days + days[:1], days) == (True, True, True)
    for d in days:
        assert check(days, [x for x in days if x != d]) == (False, False, True)
        assert check([x for x in days if x != d], days) == (False, False, True)
    assert check(days, [days[1], *days[1:]]) == (False, True, True)
    assert check(days, [*days, None]) == (False, False, True)
    assert check([*days, None, None], [*days, None]) == (False, True, True)
    assert check(days, []) == (False, False, False)
    assert check([], days) == (False, False, True)


def test_rows_of_an_inventory_add_up(spark):
    schema = f"symbol string, file string, wanted boolean, recorded {artifacts.FILE_CONTENT}, actual {artifacts.FILE_CONTENT}"
    check = lambda *rows: tuple(artifacts.listed_inventory_checks(spark.createDataFrame([("A", "f", *r) for r in rows], schema), ["symbol"]).first())[1:]
    one, other = (2, "aa"), (2, "bb")
    assert check((True, one, one)) == check((True, None, None), (False, one, None), (False, None, one)) == (True, True, True, True)
    assert check((True, one, other)) == check((True, one, one), (False, None, other)) == (True, True, True, False)
    assert check((True, one, None)) == (True, False, True, False)
    assert check((False, None, one)) == (True, True, False, True)
    assert check((True, (2, None), (2, None))) == (True, True, True, True)


def test_inventory_is_one_set(spark):
    def check(wanted, recorded, actual):
        one = lambda files: spark.createDataFrame([("A", f, d, len(d)) for f, d in files], "symbol string, file string, sha256 string, bytes int")
        want = spark.createDataFrame([("A", f) for f in wanted], "symbol string, file string")
        row = artifacts.inventory_checks(want, one(recorded), one(actual), ["symbol"]).first()
        return row.manifest_files_exact, row.no_file_missing, row.no_file_extra, row.checksums_match

    files = [("prices.csv", "aa"), ("caps.csv", "bb")]
    names = [f for f, _ in files]
    assert check(names, files, files) == (True, True, True, True)
    assert check(names, files[:1], files) == (False, True, True, True)
    assert check(names, [*files, ("more.csv", "c")], files) == (False, True, True, False)
    assert check(names, files, files[:1]) == (True, False, True, False)
    assert check(names, files, [*files, ("more.csv", "c")]) == (True, True, False, True)
    assert check(names, files, [files[0], ("caps.csv", "bx")]) == (True, True, True, False)
    assert check(names, [*files, ("caps.csv", "bx")], files) == (True, True, True, False)


def test_identity_and_coverage_of_a_sample(spark):
    schema = "symbol string, commit string, synthetic boolean"
    for rows, one, same in (
        ([("A", "c", False)], True, True), ([("A", "c", False)] * 2, False, True), ([("A", "d", False)], True, False),
        ([("A", None, False)], True, False), ([("A", "c", True)], True, False),
    ):
        row = artifacts.identity_checks(
            spark.createDataFrame(rows, schema), {"commit": F.lit("c"), "synthetic": F.lit(False)}, ["symbol"]
        ).first()
        assert (row.one_manifest, row.producer_matches) == (one, same)
    for rows, complete in (
        ([("A", "p", 2, 2), ("A", "f", 1, 1)], True), ([("A", "p", 2, 1), ("A", "f", 1, 1)], False),
        ([("A", "p", 2, 2)], False), ([("A", "p", 0, 0), ("A", "f", 1, 1)], False), ([("A", "p", 1, 1), ("A", "p", 1, 0), ("A", "f", 1, 1)], False),
    ):
        coverage = spark.createDataFrame(rows, "symbol string, family string, requested int, returned int")
        assert artifacts.coverage_checks(coverage, ["symbol"], ("p", "f")).first().coverage_complete is complete


def test_stream_of_landed_frames_equals_batch(spark, tmp_path):
    frame, rows = audited(spark)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for symbol in ("A.NS", "B.NS"):
        frame.where(F.col("symbol") == symbol).coalesce(1).write.mode("append").parquet(landing)
        query = landed.start_audit(
            landed.stream_frames(spark, landing), out, str(tmp_path / "checkpoint"), date(2026, 9, 14), date(2026, 9, 19)
        )
        query.awaitTermination(120)
    streamed = spark.read.parquet(out + "/rows").select("symbol", "row_position", "reasons")
    assert sorted(map(tuple, streamed.collect())) == sorted(
        map(tuple, rows.select("symbol", "row_position", "reasons").collect())
    )
    verdicts = {r.symbol: (r.batch, r.passed) for r in spark.read.parquet(out + "/verdicts").collect()}
    assert verdicts == {"A.NS": (0, True), "B.NS": (1, False)}


def test_a_frame_over_several_batches_is_judged_as_one(spark, tmp_path):
    frame, _ = audited(spark)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    one = frame.where("symbol = 'A.NS'")
    again = one.where("row_position = 0").withColumn("row_position", F.lit(9).cast("bigint"))
    for part in (one, again, frame.where("symbol = 'B.NS'")):
        part.coalesce(1).write.mode("append").parquet(landing)
        landed.start_audit(
            landed.stream_frames(spark, landing), out, str(tmp_path / "checkpoint"), date(2026, 9, 14), date(2026, 9, 19)
        ).awaitTermination(120)
    verdicts = {r.symbol: (r.batch, r.passed, r.rejected_rows) for r in landed.current(spark, out).collect()}
    assert verdicts == {"A.NS": (1, False, 2), "B.NS": (2, False, 1)}
    assert landed.current(spark, out, "rows").count() == 6


def land_stream(spark, landing, out, checkpoint, symbol=r"^(.*?)(?:\.[0-9]+)?\.csv$"):
    query = landed.start_audit(
        landed.stream_lines(spark, landing), out, checkpoint, date(2026, 9, 14), date(2026, 9, 19),
        frames_of=lambda batch: landed.frames_of_batch(batch, symbol),
    )
    query.awaitTermination(180)


def test_stream_of_lines_judges_a_frame_over_three_batches(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    (landing / "r1").mkdir(parents=True)
    (landing / "r2").mkdir()
    row = lambda day, opened="10": f"2026-09-{day},{opened},12,9,11,5.5,100\n"
    batches = [
        {"r1/A.NS.1.csv": HEADER + row(14) + row(15), "r1/B.NS.csv": HEADER + row(14), "r2/A.NS.csv": HEADER + row(14) + row(14)},
        {"r1/A.NS.2.csv": HEADER + row(16), "r1/C.NS.csv": "Date,Open,Open,Low,Close,Volume\n2026-09-14,1,1,1,1,1\n"},
        {"r1/A.NS.3.csv": HEADER + row(15) + row(17, "nan"), "r1/D.NS.csv": HEADER + row(14)},
        {"r1/D.NS.2.csv": HEADER + row(15, "x")},
    ]
    for n, files in enumerate(batches):
        for name, text in files.items():
            (landing / name).write_text(text)
        land_stream(spark, str(landing), out, checkpoint)
        assert spark.read.parquet(f"{out}/rows/batch={n}").count() == sum(t.count("\n") - 1 for t in files.values())
    verdicts = {(r.run_id, r.symbol): r for r in landed.current(spark, out).collect()}
    facts = {k: (r.batch, r.frame_rows, r.usable_rows, r.passed, r.category) for k, r in verdicts.items()}
    assert facts == {
        ("r1", "A.NS"): (2, 5, 2, False, "unverified_response"), ("r1", "B.NS"): (0, 1, 1, True, "admitted_frame"),
        ("r2", "A.NS"): (0, 2, 0, False, "unverified_response"), ("r1", "C.NS"): (1, 1, 0, False, "unverified_response"),
        ("r1", "D.NS"): (3, 2, 1, False, "unverified_response"),
    }
    assert verdicts["r1", "A.NS"].rejection_counts == {"duplicate_date": 2, "missing:Open": 1}
    assert verdicts["r1", "C.NS"].frame_errors == ["ambiguous_columns"]
    assert verdicts["r1", "D.NS"].frame_errors == ["nonnumeric_column:Open"]
    rows = {(r.symbol, str(r.session_date), r.row_position): (r.reasons, r.accepted)
            for r in landed.current(spark, out, "rows").where("run_id = 'r1'").collect()}
    assert rows["A.NS", "2026-09-15", 1] == rows["A.NS", "2026-09-15", 0] == (["duplicate_date"], False)
    assert rows["A.NS", "2026-09-14", 0] == ([], True) and rows["A.NS", "2026-09-17", 1] == (["missing:Open"], False)


def test_a_batch_reads_no_more_when_more_has_landed(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    read = []
    for n in range(5):
        run = landing / f"r{n}"
        run.mkdir(parents=True)
        (run / f"S{n}.NS.csv").write_text(HEADER + ROWS)
        land_stream(spark, str(landing), out, checkpoint)
        slots = [p for p in (tmp_path / "out" / "counts" / "days").iterdir() if p.name.startswith("slot=")]
        of_batch = [p for p in slots if any(b.name == f"batch={n}" for b in p.iterdir())]
        read.append(sum(f.stat().st_size for p in of_batch for f in p.rglob("part-*")))
    assert len(slots) == 5 and max(read) < 1.2 * min(read)


HEADER = "Date,Open,High,Low,Close,Adj Close,Volume\n"
ROWS = "2026-09-14,10,12,9,11,5.5,100\n2026-09-15,11,13,10,12,,200\n"


def test_landed_price_files_are_judged_by_their_own_header(spark, tmp_path):
    from barledger.sources.prices import scan_price_files

    run = tmp_path / "run-1"
    run.mkdir()
    (run / "GOOD.NS.csv").write_text(HEADER + ROWS)
    (run / "SWAPPED.NS.csv").write_text("Volume,Close,Low,High,Open,Date\n100,11,9,12,10,2026-09-14\n")
    (run / "TWICE.NS.csv").write_text("Date,Open,Open,Low,Close,Volume\n2026-09-14,1,1,1,1,1\n")
    (run / "SHORT.NS.csv").write_text("Date,Open,High,Low,Volume\n2026-09-14,1,1,1,1\n")
    (run / "TEXT.NS.csv").write_text(HEADER + ROWS + "2026-09-16,x,12,9,11,5.5,100\n")
    (run / "UNDATED.NS.csv").write_text(HEADER + ROWS + "soon,10,12,9,11,5.5,100\n")
    (run / "MIXED.NS.csv").write_text(HEADER + ROWS + "2026-09-16,NaN,inf,9,11,bad,100\n")
    for hot_rows in (1, 1000):
        frames = scan_price_files(spark, str(tmp_path), hot_rows=hot_rows)
        audited = audit.audit_rows(
            frames, date(2026, 9, 14), date(2026, 9, 19), frame_errors="frame_errors", hot_rows=hot_rows
        )
        verdicts = {r.symbol: r for r in audit.frame_verdicts(audited).collect()}
        assert {s for s, r in verdicts.items() if r.passed} == {"GOOD.NS", "SWAPPED.NS"}
        assert verdicts["TWICE.NS"].frame_errors == ["ambiguous_columns"]
        assert verdicts["SHORT.NS"].frame_errors == ["missing_ohlcv_columns"]
        assert verdicts["TEXT.NS"].frame_errors == ["nonnumeric_column:Open"]
        assert verdicts["UNDATED.NS"].frame_errors == ["not_a_datetime_index"]
        assert verdicts["MIXED.NS"].category == "row_quality_rejected"
        assert verdicts["MIXED.NS"].run_id == "run-1"
        rejected = audited.where("symbol = 'MIXED.NS' AND NOT accepted").collect()
        assert [(r.row_position, r.reasons) for r in rejected] == [
            (2, ["missing:Open", "nonfinite:High", "invalid:Adj Close"])
        ]


def test_positions_of_a_file_cut_into_blocks(spark, tmp_path):
    from barledger.sources.lines import number_lines, read_lines

    (tmp_path / "big.csv").write_text("Date,Symbol\n" + "".join(f"x,{i:06d}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, str(tmp_path), "*.csv")
        assert lines.select("block").distinct().count() > 3
        rows = number_lines(lines).collect()
        assert [r.line for r in rows if r.row_position == -1] == ["Date,Symbol"]
        data = [r for r in rows if r.row_position >= 0]
        assert len(data) == 5000 and all(int(r.line.split(",")[1]) == r.row_position for r in data)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_whole_numbers_stay_whole(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\n9223372036854775807,123456789012345678901,1.5,1\n1,2,9223372036854775808,x\n")
    table = tables.load_csv(spark, str(tmp_path / "t.csv"))
    assert dict(table.dtypes) == {"a": "bigint", "b": "decimal(38,0)", "c": "string", "d": "string"}
    assert {r.a for r in table.collect()} == {9223372036854775807, 1}
    assert {int(r.b) for r in table.collect()} == {123456789012345678901, 2}


def test_a_row_longer_than_its_header_is_no_table(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a,b\n1,2\n3,4,5\n")
    (tmp_path / "short.csv").write_text("a,b\n1,2\n3\n")
    assert tables.load_csv(spark, str(tmp_path / "long.csv")) is None
    assert tables.load_csv(spark, str(tmp_path / "long.csv"), "a int, b int") is None
    assert tables.load_csv(spark, str(tmp_path / "short.csv")).count() == 2


def test_records_with_line_breaks_are_whole(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",2\nz,3\n')
    assert sorted(map(tuple, tables.load_csv(spark, str(tmp_path / "t.csv")).collect())) == [("x\ny", 2), ("z", 3)]


def test_cells_that_do_not_parse_are_told_from_missing_ones(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2020-01-01\nx,\n,soon\n")
    rows = tables.load_csv(spark, str(tmp_path / "t.csv"), "a int, b date", unparsed="lost").collect()
    assert [(r.a, [tuple(x) for x in r.lost]) for r in rows] == [(1, []), (None, [("a", "x")]), (None, [("b", "soon")])]


def test_deals_are_neither_filled_nor_rounded(spark, tmp_path):
    land(tmp_path, _17Sep2026="Date,Symbol,Price,Quantity\nnot-a-date,A,10.005,many\n2026-09-17,B,x,5\n,C,1,1\n")
    rows = {r.symbol: r for r in scan(spark, tmp_path, end=DAY)[0].collect()}
    assert rows["A"].deal_date is None and rows["A"].date_text == "not-a-date" and rows["A"].file_day == DAY
    assert str(rows["A"].price.normalize()) == "10.005" and rows["A"].quantity is None and rows["A"].quantity_text == "many"
    assert rows["B"].price is None and rows["B"].price_text == "x" and rows["B"].deal_date == DAY
    assert rows["C"].deal_date is None and rows["C"].date_text is None


@pytest.mark.parametrize("text", ["", "\n \n"])
def test_empty_file_blocks(spark, tmp_path, text):
    land(tmp_path, _17Sep2026=text, _18Sep2026=GOOD)
    rows, family = scan(spark, tmp_path)
    assert (family.blocked, family.not_attempted, family.success) == (1, 1, False) and rows.count() == 1


def test_inventory_lists_every_file_once(spark, tmp_path):
    from barledger.sources.lines import read_files

    folder = tmp_path / "a folder"
    folder.mkdir()
    land(folder, _17Sep2026="", _18Sep2026=GOOD)
    files = read_files(spark, str(tmp_path), "*.csv").collect()
    assert sorted((r.name, r.bytes) for r in files) == [("bulkdeals_17Sep2026.csv", 0), ("bulkdeals_18Sep2026.csv", len(GOOD))]
    rows, family = scan(spark, tmp_path, start=NEXT)
    assert rows.count() == 1 and family.success


def test_open_quote_blocks(spark, tmp_path):
    land(tmp_path, _17Sep2026='Date,Symbol,Client\n2026-09-17,A,"x\ny\n')
    rows, family = scan(spark, tmp_path, end=DAY)
    assert rows.count() == 0 and family.blocked == 1


def test_records_over_lines_are_rows(spark, tmp_path):
    land(tmp_path, _17Sep2026='Date,Symbol,Client\n2026-09-17,A,"x\n\ny, ""z"""\n\n2026-09-17,B,c\n')
    rows, family = scan(spark, tmp_path, end=DAY)
    assert {r.symbol: r.client for r in rows.collect()} == {"A": 'x\n\ny, "z"', "B": "c"} and family.success


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_records_are_the_same_in_many_splits(spark, tmp_path, split):
    from barledger.sources.lines import number_lines, read_lines

    rows = [f'{i},"line one {i}\n\nline ""two""\n",{i}' if i % 3 == 0 else f"{i},plain,{i}" for i in range(200)]
    (tmp_path / "a.csv").write_text("n,text,m\n" + "\n".join(rows) + "\n")
    (tmp_path / "b.csv").write_text("n,text,m\n" + "\n".join(r for r in rows if "\n" not in r) + "\n\n")
    (tmp_path / "c.csv").write_text('n,text,m\n1,"x\ny",2\n3,"open,4\n5,z,6\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {}
        for r in number_lines(read_lines(spark, str(tmp_path), "*.csv")).collect():
            got.setdefault(r.name, {})[r.row_position] = r.line
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, lines in (("a.csv", rows), ("b.csv", [r for r in rows if "\n" not in r])):
        assert got[name] == {-1: "n,text,m", **dict(enumerate(lines))}
    # a quote that never ends: its file keeps its lines, and they show it
    assert got["c.csv"] == {-1: "n,text,m", 0: '1,"x', 1: 'y",2', 2: '3,"open,4', 3: "5,z,6"}


def test_csv_numbers_are_exact(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "a,b,c,d,e,f\n0.1234567890123456789,9007199254740993.0,1.5,1e300,0.30000000000000004,1e5\n-2,1,2.25,2,1,1.2345678901234567891e3\n"
    )
    table = tables.load_csv(spark, str(tmp_path / "t.csv"))
    assert dict(table.dtypes) == {
        "a": "decimal(20,19)", "b": "decimal(17,1)", "c": "double", "d": "double", "e": "double", "f": "string",
    }
    rows = [tuple(map(str, r)) for r in table.collect()]
    assert rows[0] == ("0.1234567890123456789", "9007199254740993.0", "1.5", "1e+300", "0.30000000000000004", "1e5")
    assert rows[1][:2] == ("-2.0000000000000000000", "1.0")


def test_csv_number_types_at_their_bounds(spark, tmp_path):
    nines = "9" * 38
    (tmp_path / "t.csv").write_text(f"a,b,c,d\n{nines},{nines}9,9223372036854775808,-7\n1,1,1e300,9223372036854775807\n")
    table = tables.load_csv(spark, str(tmp_path / "t.csv"))
    assert dict(table.dtypes) == {"a": "decimal(38,0)", "b": "string", "c": "string", "d": "bigint"}
    assert [tuple(map(str, r))[:3] for r in table.collect()] == [(nines, nines + "9", "9223372036854775808"), ("1", "1", "1e300")]


def test_csv_row_like_its_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\na,b\n")
    table = tables.load_csv(spark, str(tmp_path / "t.csv"))
    assert dict(table.dtypes) == {"a": "string", "b": "string"} and table.count() == 2


def test_headers_that_fold_together_or_collide(spark, tmp_path):
    land(tmp_path, _17Sep2026="Date,Symbol,SYMBOL\n2026-09-17,A,B\n", _18Sep2026="Symbol,Date,a,a,a.1\nC,2026-09-18,1,2,3\n")
    rows = {r.symbol: r.extras for r in scan(spark, tmp_path)[0].collect()}
    assert rows == {"A": {"SYMBOL": "B"}, "C": {"a": "1", "a.1": "2", "a.1.1": "3"}}


def test_rejected_rows_keep_what_the_file_had(spark, tmp_path):
    from barledger.sources.prices import scan_price_files

    for run in ("x/run", "y/run"):
        (tmp_path / run).mkdir(parents=True)
    (tmp_path / "x/run/A.NS.csv").write_text(HEADER.strip() + ",Dividends\n2026-09-14,abc,12,9,11,NaN,100,0.5\n")
    (tmp_path / "x/run/B.NS.csv").write_text("Date,Open,Open,Low,Close,Volume\n2026-09-14,1,2,x,1,1\n")
    (tmp_path / "y/run/A.NS.csv").write_text(HEADER + ROWS + "2026-09-16,10,12,9,11,5.5,100,7\n")
    frames = scan_price_files(spark, str(tmp_path))
    rows = audit.audit_rows(frames, date(2026, 9, 14), date(2026, 9, 19), frame_errors="frame_errors")
    verdicts = {(r.run_id, r.symbol): r.frame_errors for r in audit.frame_verdicts(rows).collect()}
    assert verdicts == {
        ("x/run", "A.NS"): ["nonnumeric_column:Open"], ("x/run", "B.NS"): ["ambiguous_columns"],
        ("y/run", "A.NS"): ["ambiguous_columns"],
    }
    cells = {(r.run_id, r.symbol, r.row_position): [tuple(c) for c in r.cells] for r in audit.rejected_rows(rows).collect()}
    assert cells["x/run", "A.NS", 0] == [
        ("Date", "string", "'2026-09-14'"), ("Open", "string", "'abc'"), ("High", "double", "12"), ("Low", "double", "9"),
        ("Close", "double", "11"), ("Adj Close", "null", "'NaN'"), ("Volume", "double", "100"), ("Dividends", "double", "0.5"),
    ]
    assert [c[:1] + c[2:] for c in cells["x/run", "B.NS", 0]][1:4] == [("Open", "1"), ("Open", "2"), ("Low", "'x'")]
    assert cells["y/run", "A.NS", 2][-1] == ("", "double", "7")


def test_evidence_of_tables_that_fail_the_gate(spark):
    odd = spark.createDataFrame([("r", "A.NS", 0, "soon", 1.0, 2.0, 3)], "run_id string, symbol string, row_position int, ts string, x double, y double, more int")
    rows = audit.rejected_rows(audit.audit_rows(odd.toDF("run_id", "symbol", "row_position", "ts", "x", "x", "more"), DAY, NEXT)).first()
    assert rows.date is None and rows["index"].repr == "'soon'" and rows.reasons == ["ambiguous_columns", "not_a_datetime_index"]
    assert [tuple(c) for c in rows.cells] == [("x", "double", "1.0"), ("x", "double", "2.0"), ("more", "int", "3")]


def test_long_lines_are_split_in_their_length(spark):
    """Looking ahead at each comma, one line of 60,000 fields takes minutes; quotes, ends and empty fields stay as they were."""
    rows = spark.createDataFrame([("x," * 60_000 + "y\r",), ('a,"b, ""c""",\r',), (",,",)], "line string")
    begin = time.time()
    found = [tuple(r) for r in rows.select(F.size(split_fields(F.col("line"))), F.slice(split_fields(F.col("line")), -2, 2)).collect()]
    assert found == [(60_001, ["x", "y"]), (3, ['b, "c"', ""]), (3, ["", ""])]
    assert time.time() - begin < 20


def test_records_join_without_moving_their_lines(spark, tmp_path):
    """Breaks in quotes over many blocks, blank lines, a quoted header; the lines themselves cross no exchange."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    notes = [f"n{i}" + "\n\n" * (i % 3) + f'"{i}" ,' + "x" * (i % 50) for i in range(2_000)]
    body = "".join(f'{i},"{note.replace(chr(34), chr(34) * 2)}"\n' + "\n" * (i % 2) for i, note in enumerate(notes))
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text('"i","no\nte"\n' + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        records = data_records(located(spark.read.text(str(tmp_path))))
        have = sorted(r[0] for r in records.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [f'{i},"{note.replace(chr(34), chr(34) * 2)}"' for i, note in enumerate(notes)]
    assert have == sorted(want * 2)


def test_bundle_paths_are_decoded_once_a_file(spark, tmp_path):
    """Rows are counted by their file's path as it is; what is made of the path stands above the counting."""
    for part in evidence.PARTS:
        rows = spark.range(3).selectExpr("cast(id as string) value")
        (rows.write.text if part == "rejected" else rows.write.parquet)(str(tmp_path / "b" / part))
    files = evidence.bundle_files(spark, str(tmp_path / "b"))
    assert {r.file.split("/")[0] for r in files.collect()} == set(evidence.PARTS)
    assert files.agg(F.sum("rows")).first()[0] == 9
    plan = files._jdf.queryExecution().optimizedPlan().toString().splitlines()
    counting = [i for i, line in enumerate(plan) if "Aggregate [" in line]
    assert counting
    for i in counting:
        keys = plan[i].split("Aggregate [")[1].split("], [")[0]
        assert "substring_index" not in keys and "substring_index" not in plan[i + 1]
