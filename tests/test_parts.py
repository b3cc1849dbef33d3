"""Part sets and the version log: replacement, pruning, manifests, retention, conflicts."""

import gzip
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerstar.sources import landing, parts
from ledgerstar.sources.versions import Conflict, VersionLog, new_version
from parity import workspace
from tests.conftest import SF

HEADER = ["Invoice Line No", "Date", "Name", "Odd `Name`"]


def raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c.replace('`', '``')}` string" for c in HEADER))


def days(n, year=2023):
    return [(f"INV-{i:04d}", f"{year}-{1 + i % 12:02d}-{1 + i % 28:02d}T00:00:00.000", f'n "{i}",\nx', "") for i in range(n)]


def text(rows):
    return sorted(tuple(v or "" for v in r) for r in rows)


@pytest.fixture(params=["plain", "odd %20 name+#ü"])
def root(tmp_path, request):
    return str(tmp_path / request.param)


def test_a_new_set_takes_the_place_of_the_old_one(spark, root):
    old_rows, new_rows = days(100), days(60, 2024)
    old = parts.replace_parts(raw(spark, old_rows), root, "2023-01-01", "2023-12-31", 30)
    reader = parts.open_parts(spark, root)
    held = reader.rows()
    parts.replace_parts(raw(spark, new_rows + old_rows), root, "2024-01-01", "2024-12-31", 1000)
    # who opened the old set reads it on, before and after planning
    assert text(held.collect()) == text(old_rows) == text(reader.rows().collect())
    newest = parts.open_parts(spark, root)
    assert text(newest.rows().collect()) == text(new_rows)
    assert max(r.rows for r in old.manifest.collect()) <= 30
    row = newest.summary.first()
    assert (row.start_date, row.end_date, row.limit, row.total_rows) == ("2024-01-01", "2024-12-31", 1000, 60)
    assert row.file_count == len(newest.rows().inputFiles())


def test_a_writer_lost_half_way_changes_nothing(spark, root, monkeypatch):
    rows = days(50)
    parts.replace_parts(raw(spark, rows), root, "2023-01-01", "2023-12-31", 10)

    def lost(*_):
        raise KeyboardInterrupt

    for name, module in (("manifest_of", landing), ("write_parts", landing)):
        with monkeypatch.context() as patch:
            patch.setattr(module, name, lost)
            with pytest.raises(KeyboardInterrupt):
                parts.replace_parts(raw(spark, days(5)), root, "2023-01-01", "2023-12-31", 10)
    assert text(parts.open_parts(spark, root).rows().collect()) == text(rows)
    failing = raw(spark, days(50)).withColumn("Name", F.when(F.col("Name") == 'n "49",\nx', F.raise_error(F.lit("bad"))).otherwise(F.col("Name")))
    with pytest.raises(Exception, match="bad"):
        parts.replace_parts(failing, root, "2023-01-01", "2023-12-31", 10)
    assert text(parts.open_parts(spark, root).rows().collect()) == text(rows)


def test_a_slice_opens_only_parts_with_its_days(spark, root):
    rows = days(600) + [("INV-X", "", "undated", "")]
    held = parts.replace_parts(raw(spark, rows), root, "2023-01-01", "2023-12-31", 20)
    for start, end in (("2023-03-01", "2023-03-31"), ("2023-05-09", "2023-05-09"), ("2023-01-01", "2023-12-31")):
        cut = held.slice(start, end)
        whole = landing.slice_raw(held.rows().withColumnRenamed("Date", "date"), start, end)
        assert text(cut.collect()) == text(whole.collect())
        met = {r.file for r in held.manifest.collect() if r.first_day <= end and r.last_day >= start}
        assert {landing._base_name(f) for f in cut.inputFiles()} == {landing._base_name(f) for f in met}
    total = len(held.rows().inputFiles())
    assert len(held.slice("2023-03-01", "2023-03-31").inputFiles()) <= total // 4
    with pytest.raises(FileNotFoundError):
        held.slice("2022-01-01", "2022-12-31")
    assert held.slice("2022-01-01", "2022-12-31", must_match=False).count() == 0
    assert held.rows().count() == 600  # rows without a date are not landed


def test_manifest_counts_each_file(spark, tmp_path):
    (tmp_path / "a #1%.csv").write_text("date,store\n2023-01-02,1\n,2\n2023-01-01T00:00:00,3\n")
    (tmp_path / "b+c.csv").write_text('date,store\n2024-05-05,"x\ny"\n')
    (tmp_path / "empty.csv").write_text("date,store\n")
    table = landing.file_manifest(spark, str(tmp_path))
    found = {r.name: tuple(r)[1:-1] for r in table.withColumn("name", landing.base_name(F.col("file"))).collect()}
    assert found == {
        "a #1%.csv": (3, 2, "2023-01-01", "2023-01-02"),
        "b+c.csv": (1, 1, "2024-05-05", "2024-05-05"),
        "empty.csv": (0, 0, None, None),
    }
    files = landing.list_files(spark, str(tmp_path), "*.csv")
    row = landing.extract_manifest(spark, files, "2023-01-01", "2024-12-31", 10).first()
    assert (row.file_count, row.total_rows) == (3, 4)
    assert [f.rsplit("/", 1)[1] for f in row.files] == ["a #1%.csv", "b+c.csv", "empty.csv"]
    plan = landing.extract_manifest(spark, files, "2023-01-01", "2024-12-31", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "b+c" not in plan and "empty.csv" not in plan
    assert landing.extract_manifest(spark, [], "2023-01-01", "2024-12-31", 10).first().file_count == 0


def test_without_a_source_the_landed_rows_are_cut_anew(spark, root):
    with pytest.raises(FileNotFoundError):
        parts.refresh_parts(spark, root, "2023-01-01", "2023-06-30", 10)
    rows = days(120)
    parts.refresh_parts(spark, root, "2023-01-01", "2023-12-31", 50, source=raw(spark, rows))
    half = parts.refresh_parts(spark, root, "2023-02-01", "2023-06-30", 7)
    want = [r for r in rows if "2023-02-01" <= r[1][:10] <= "2023-06-30"]
    assert text(half.rows().collect()) == text(want) == text(parts.open_parts(spark, root).rows().collect())
    with pytest.raises(FileNotFoundError):
        parts.refresh_parts(spark, root, "2021-01-01", "2021-12-31", 7)
    assert text(parts.open_parts(spark, root).rows().collect()) == text(want)


def test_an_empty_set_can_be_landed(spark, root):
    held = parts.replace_parts(raw(spark, days(3)), root, "2020-01-01", "2020-12-31", 7)
    assert held.rows().count() == 0 and held.summary.first().total_rows == 0
    assert held.slice("2020-01-01", "2020-12-31", must_match=False).columns == HEADER


# ---- the log

def begun(log, text_="x"):
    version = new_version()
    Path(log.path(version)).mkdir(parents=True)
    Path(log.path(version), "data").write_text(text_)
    return version, log.last_number()


def test_of_two_writers_one_wins(spark, root):
    log = VersionLog(spark, root)
    assert log.newest() is None and log.last_number() == 0
    (first, a), (second, b) = begun(log), begun(log)
    log.publish(second, b)
    with pytest.raises(Conflict):
        log.publish(first, a)
    assert log.newest().version == second
    third, c = begun(log)
    log.publish(third, c, {"n": 1})
    assert [x.version for x in log.history()] == [second, third] and log.newest().facts == {"n": 1}


def test_many_writers_at_once(spark, root):
    log = VersionLog(spark, root)
    started = [begun(log) for _ in range(8)]

    def publish(item):
        try:
            return log.publish(*item).version
        except Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [v for v in pool.map(publish, started) if v]
    assert log.newest().version in won and len(log.history()) == 1


def test_a_record_never_filled_names_nothing(spark, root):
    log = VersionLog(spark, root)
    version, after = begun(log)
    log.publish(version, after)
    for torn in ("", '{"version": "x"'):
        Path(root, "commits", f"{log.last_number() + 1:012d}.json").write_text(torn)
        assert log.newest().version == version
    later, after = begun(log)
    log.publish(later, after)
    assert log.newest().version == later and json.loads(Path(root, "commits", "000000000004.json").read_text())


def test_versions_nobody_needs_are_removed(spark, root):
    log = VersionLog(spark, root)
    failed, _ = begun(log)
    old, a = begun(log)
    log.publish(old, a)
    current, b = begun(log)
    log.publish(current, b)
    Path(log.path("kept by hand")).mkdir()
    grace, now = timedelta(hours=1), datetime.now(timezone.utc)
    assert log.collect(grace, now) == []  # readers of the old version have an hour left
    assert Path(log.path(old), "data").read_text() == "x"
    assert sorted(log.collect(grace, now + timedelta(hours=2))) == sorted([failed, old])
    assert log.newest().version == current and Path(log.path("kept by hand")).exists()
    assert log.collect(grace, now + timedelta(days=9)) == []
    with pytest.raises(FileNotFoundError):
        log.publish(failed, log.last_number())
    again, c = begun(log)
    assert log.publish(again, c).number == 3


def test_old_sets_of_parts_are_removed(spark, root):
    for year in (2023, 2024):
        parts.replace_parts(raw(spark, days(5, year)), root, f"{year}-01-01", f"{year}-12-31", 7)
    assert len(parts.collect_parts(spark, root, timedelta(0))) == 1
    assert parts.open_parts(spark, root).rows().count() == 5


def test_packed_parts_are_written_at_the_fastest_level(spark, tmp_path):
    rows = spark.range(20000).select(*[F.sha2(F.concat(F.col("id") % 700, F.lit(n)), 256).alias(n) for n in ("a", "b")])
    landing.write_parts(rows.coalesce(1), str(tmp_path / "parts"), 20000, packed=True)
    (part,) = (tmp_path / "parts").glob("*.csv.gz")
    text = gzip.decompress(part.read_bytes())
    assert text.count(b"\n") == 20001
    assert part.stat().st_size > 1.02 * len(gzip.compress(text, 6))


def test_both_sets_of_a_workspace_read_rows_that_were_joined_once(spark, monkeypatch):
    given = []
    real = workspace.replace_parts
    monkeypatch.setattr(workspace, "replace_parts", lambda rows, *a: given.append(rows) or real(rows, *a))
    assert workspace.Workspace(spark, SF).part_set.manifest.count() > 0
    assert len(given) == 2
    for rows in given:
        assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()
