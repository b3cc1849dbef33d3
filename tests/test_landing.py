import json

import pytest
from pyspark.sql import functions as F

from ledgerstar.operators import dimensions
from ledgerstar.operators.cleaning import clean_extracts, clean_sales, number_lines
from ledgerstar.schemas import STAGING_TYPES
from ledgerstar.sources import landing
from parity import catalog, workspace
from tests.compare import connect, differences
from tests.conftest import SF

ONE_ROW = (
    "invoice_line_no,date,store,name,store_location\n"
    "INV-1,2023-01-03T00:00:00.000,1001,Sample Store,POINT (-93.61378 41.60575)\n"
)


def write(folder, name, content):
    path = folder / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_one_row_part_becomes_a_staging_row(spark, tmp_path):
    path = write(tmp_path, "sales_sample.csv", ONE_ROW)
    staged = clean_sales(landing.read_raw(spark, [path]))
    assert staged.columns == list(STAGING_TYPES)
    row = staged.first()
    assert (float(row.latitude), float(row.longitude)) == (41.60575, -93.61378)
    assert (row.store_number, row.store_name, row.source_file) == (
        "1001", "Sample Store", "sales_sample.csv",
    )
    assert row.pack is None and row.proof is None and row.sale_dollars is None


def test_row_hash_of_the_known_sample(spark, tmp_path):
    content = "invoice_line_no,date,store,name\nINV-54555400001,2023-01-01,2190,Any Store\n"
    path = write(tmp_path, "sales_sample.csv", content)
    row = clean_sales(landing.read_raw(spark, [path])).first()
    # Stated in FIXTURES.md, section 4.
    expected = "7200744cb89ca2c0a49e70bbd97d7176a16cb40c1b1ac1237aeadacd65d8444c"
    assert row.source_row_hash == expected


def test_source_coordinates_win_only_as_a_pair(spark, tmp_path):
    both = write(tmp_path, "b.csv", "store,latitude,longitude,store_location\n1,1.5,2.5,POINT (-9 8)\n")
    half = write(tmp_path, "h.csv", "store,latitude,store_location\n1,1.5,POINT (-9 8)\n")
    none = write(tmp_path, "n.csv", "store,latitude\n1,1.5\n")
    got = []
    for path in (both, half, none):
        r = clean_sales(landing.read_raw(spark, [path])).first()
        got.append((r.latitude and float(r.latitude), r.longitude and float(r.longitude)))
    assert got == [(1.5, 2.5), (8.0, -9.0), (None, None)]


def test_quotes_line_breaks_and_blanks(spark, tmp_path):
    path = write(tmp_path, "q.csv", 'store,name\n1,"a ""b""\nc"\n2,\n')
    rows = landing.read_raw(spark, [path]).orderBy("staging_key").collect()
    assert [(r.store, r.name) for r in rows] == [("1", 'a "b"\nc'), ("2", "")]


def test_parts_must_share_a_header(spark, tmp_path):
    a = write(tmp_path, "a.csv", "store,name\n1,x\n")
    b = write(tmp_path, "b.csv", "name,store\nx,1\n")
    with pytest.raises(Exception, match="header"):
        landing.read_raw(spark, [a, b]).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_are_ordered_by_file_and_place(spark, tmp_path, multi_line):
    files = []
    for n in ("p2", "p1", "p3"):
        lines = "".join(f"{n}-{i}\n" for i in range(50 if n == "p1" else 20))
        files.append(write(tmp_path, f"{n}.csv", "store\n" + lines))
    rows = landing.read_raw(spark, files, multi_line).orderBy("source_file", "source_position").collect()
    expected = [f"{n}-{i}" for n in ("p1", "p2", "p3") for i in range(50 if n == "p1" else 20)]
    assert [r.store for r in rows] == expected
    assert len({r.staging_key for r in rows}) == len(rows)


def test_split_files_keep_their_row_order(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = write(tmp_path, "big.csv", "store\n" + "".join(f"{i:06d}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = landing.read_raw(spark, [path], multi_line=False)
        rows = df.orderBy("source_position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.store for r in rows] == [f"{i:06d}" for i in range(3000)]
    assert len({r.staging_key for r in rows}) == 3000


def test_volumes_of_a_name_go_on_one_after_the_other(spark, tmp_path):
    files = []
    for volume in (10, 2, 0):
        (tmp_path / f"volume={volume}").mkdir()
        lines = "".join(f"{volume:02d}-{i:03d}\n" for i in range(100 if volume == 2 else 30))
        files.append(write(tmp_path / f"volume={volume}", "a b.csv", "store\n" + lines))
    staged = clean_sales(landing.read_raw(spark, files))
    rows = number_lines(staged, "line").orderBy("line").collect()
    assert [r.line for r in rows] == list(range(1, 161))
    assert [r.store_number for r in rows] == sorted(r.store_number for r in rows)
    assert {r.source_file for r in rows} == {"a b.csv"}


def test_lines_are_numbered_over_many_runs(spark):
    places = [7, 65_535, 65_536, 70_000, 1 << 40, (1 << 42) + 3]
    rows = [(100 - i, f, p) for f in ("a", "b") for i, p in enumerate(places)] + [(5, None, None), (3, None, None)]
    landed = spark.createDataFrame(rows, "staging_key bigint, source_file string, source_position bigint")
    numbered = number_lines(landed, "line")
    found = {(r.source_file, r.source_position, r.staging_key): r.line for r in numbered.collect()}
    assert [found["a", p, 100 - i] for i, p in enumerate(places)] == [1, 2, 3, 4, 5, 6]
    assert [found["b", p, 100 - i] for i, p in enumerate(places)] == [1, 2, 3, 4, 5, 6]
    assert (found[None, None, 3], found[None, None, 5]) == (1, 2)


def test_no_odd_file_is_larger_than_a_volume(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "VOLUME_ROWS", 200)
    space = workspace.Workspace(spark, SF)
    space.root = str(tmp_path / "space")
    frames = landing.read_extracts(spark, [space.odd_parts])
    counts = [r for f in frames for r in f.groupBy("source_file", F.input_file_name()).count().collect()]
    assert {r.source_file for r in counts} == set(workspace.ODD_NAMES)
    assert len(counts) > 20 and max(r["count"] for r in counts) <= 200
    query = catalog.comparable(catalog._odd_landing(space))
    assert differences(query, connect(SF), catalog.ORACLES["t3_odd_names_and_headers"]) is None


def test_packed_parts_hold_the_same_rows(spark, tmp_path):
    rows = [(f"{i}", f'a "{i}"\n, b' if i % 3 else " ") for i in range(500)]
    df = spark.createDataFrame(rows, "store string, name string").coalesce(1)
    for packed in (False, True):
        landing.write_parts(df, str(tmp_path / f"{packed}"), 100, packed=packed)
    files = landing.find_raw_files(spark, str(tmp_path / "True"), pattern="*.csv.gz")
    assert len(files) == 5 and not landing.list_files(spark, str(tmp_path / "True"), "*.csv")
    got = landing.read_raw(spark, files).select("store", "name").collect()
    assert sorted(tuple(r) for r in got) == sorted(rows)
    assert {r.rows for r in landing.file_manifest(spark, files).collect()} == {100}
    size = {p: sum(f.stat().st_size for f in (tmp_path / p).glob("part*")) for p in ("True", "False")}
    assert 3 * size["True"] < size["False"]


def test_landed_parts_and_part_sets_are_packed(spark, tmp_path):
    space = workspace.Workspace(spark, SF)
    space.root = str(tmp_path / "space")
    for folder in (space.parts, f"{space.part_set.folder}/parts"):
        names = landing.list_files(spark, folder, "part-*")
        assert names and all(n.endswith(".csv.gz") for n in names)
        assert landing.csv_lines(spark, folder).count() == space.raw().count()


def test_a_folder_can_be_read(spark, tmp_path):
    write(tmp_path, "x_part_1.csv", "store\n2\n")
    write(tmp_path, "x_part_0.csv", "store\n1\n")
    rows = landing.read_raw(spark, [str(tmp_path)]).orderBy("source_file", "source_position").collect()
    assert [r.store for r in rows] == ["1", "2"]


def test_no_files_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        landing.read_raw(spark, [])


def test_manifest_files_that_exist_come_first(spark, tmp_path):
    parts = [write(tmp_path, f"s_part_{i:03d}.csv", "date\n2023-01-01\n") for i in range(3)]
    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps({"files": [parts[2], str(tmp_path / "gone.csv")]}, indent=2))
    named = landing.find_raw_files(spark, str(tmp_path), str(manifest))
    assert [p.rsplit("/", 1)[1] for p in named] == ["s_part_002.csv"]
    manifest.write_text(json.dumps({"files": []}))
    everything = landing.find_raw_files(spark, str(tmp_path), str(manifest))
    assert [p.rsplit("/", 1)[1] for p in everything] == [f"s_part_{i:03d}.csv" for i in range(3)]
    assert len(landing.find_raw_files(spark, str(tmp_path), str(tmp_path / "none.json"))) == 3


def test_slice_is_inclusive_on_text(spark):
    df = spark.createDataFrame(
        [("2023-01-01T23:59:59",), ("2022-12-31",), ("2023-01-31",), ("",), (None,)], "date string"
    )
    kept = landing.slice_raw(df, "2023-01-01", "2023-01-31")
    assert [r.date for r in kept.collect()] == ["2023-01-01T23:59:59", "2023-01-31"]
    with pytest.raises(FileNotFoundError):
        landing.slice_raw(df, "2024-01-01", "2024-12-31")


@pytest.mark.parametrize(
    "start, end, limit",
    [("2023-1-32", "2023-01-31", 1), ("2023-02-01", "2023-01-31", 1), ("2023-01-01", "2023-01-31", 0)],
)
def test_bad_ranges(start, end, limit):
    with pytest.raises(ValueError):
        landing.check_range(start, end, limit)


def test_parts_are_bounded_and_round_trip(spark, tmp_path):
    values = [f' "v{i}",\nx ' if i % 7 == 0 else f"v{i}" for i in range(95)]
    df = spark.createDataFrame([(v, "") for v in values], "a string, b string").repartition(2)
    folder = str(tmp_path / "out")
    landing.write_parts(df, folder, 10)
    files = landing.find_raw_files(spark, folder, pattern="*.csv")
    back = landing.read_raw(spark, files)
    assert sorted((r.a, r.b) for r in back.collect()) == sorted((v, "") for v in values)
    assert max(r.rows for r in landing.rows_per_file(back).collect()) <= 10
    manifest = landing.extract_manifest(spark, files, "2023-01-01", "2023-12-31", 10)
    landing.write_manifest(manifest, str(tmp_path / "m"))
    row = landing.read_manifest(spark, str(tmp_path / "m")).first()
    assert (row.total_rows, row.file_count, len(row.files)) == (95, len(files), len(files))


def test_extracts_with_other_headers_are_cleaned_each_by_its_own(spark, tmp_path):
    paths = [
        write(tmp_path, "a.csv", "Store,Invoice Line No,store_location\n1,I1,POINT (-9 8)\n2,I2,\n"),
        write(tmp_path, "b.csv", "invoice_and_item_number,latitude,longitude,store\nI3,1.5,2.5,3\n"),
        write(tmp_path, "c.csv", "Store,Invoice Line No,store_location\n4,I4,POINT (-7 6)\n"),
    ]
    staged = clean_extracts(landing.read_extracts(spark, paths)).orderBy("source_file", "source_position").collect()
    got = [(r.invoice_and_item_number, r.store_number, r.latitude and float(r.latitude)) for r in staged]
    assert got == [("I1", "1", 8.0), ("I2", "2", None), ("I3", "3", 1.5), ("I4", "4", 6.0)]
    assert len({r.staging_key for r in staged}) == 4


def test_the_last_landed_row_of_a_day_wins(spark, tmp_path):
    head = "invoice_line_no,date,store,name\n"
    write(tmp_path, "p 2.csv", head + "I1,2023-01-01,1,second file\n" + "I2,2023-01-01,2,early\n" * 30 + "I2,2023-01-01,2,late\n")
    write(tmp_path, "p 1.csv", head + "I3,2023-01-02,3,later day\n" + "I4,2023-01-01,1,first file\n" * 400)
    write(tmp_path, "p 3.csv", head + "I5,2023-01-01,3,earlier day\n")
    staged = clean_sales(landing.read_raw(spark, [str(tmp_path)]))
    names = {r.store_number: r.store_name for r in dimensions.build("dim_store", staged, F.lit("S")).collect()}
    assert names == {"1": "second file", "2": "late", "3": "later day"}


def test_rows_of_files_join_no_listing(spark, tmp_path):
    write(tmp_path, "a.csv", "store\n1\n")
    plan = landing.read_raw(spark, [str(tmp_path)])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "LocalRelation" not in plan


def test_headers_are_told_from_the_head_alone(spark, tmp_path, monkeypatch):
    write(tmp_path, "a #1%.csv", "store,date\r\n" + "1,2023-01-01\r\n" * 9000)
    write(tmp_path, "a1x.csv", "date,store\n2023-01-01,2\n")
    assert landing.header_of(spark, str(tmp_path / "a #1%.csv")) == "store,date"
    frames = landing.read_extracts(spark, [str(tmp_path)])
    assert sorted(f.count() for f in frames) == [1, 9000]
    monkeypatch.setattr(landing, "HEAD_BYTES", 5)
    with pytest.raises(ValueError, match="header"):
        landing.read_extracts(spark, [str(tmp_path)])


@pytest.mark.parametrize("name", ["sales 2023_part_000.csv", "a%20b.csv", "a#b.csv", "a+b c.csv", "ü?.csv"])
def test_files_of_any_name_are_read(spark, tmp_path, name):
    write(tmp_path, name, "store\n1\n2\n")
    write(tmp_path, "plain.csv", "store\n3\n")
    rows = landing.read_raw(spark, [str(tmp_path)]).collect()
    assert sorted((r.source_file, r.store) for r in rows) == sorted([(name, "1"), (name, "2"), ("plain.csv", "3")])
    assert len({r.staging_key for r in rows}) == 3


def test_a_manifest_whose_folder_is_gone_falls_back_to_the_parts(spark, tmp_path):
    write(tmp_path, "s_part_000.csv", "date\n2023-01-01\n")
    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps({"files": ["/no/such/folder/s_part_000.csv"]}))
    assert len(landing.find_raw_files(spark, str(tmp_path), str(manifest))) == 1
    manifest.write_text(json.dumps({"files": ["s_part_000.csv"]}))
    assert len(landing.find_raw_files(spark, str(tmp_path), str(manifest))) == 1


def test_exports_double_quotes_and_keep_blanks(spark, tmp_path):
    report = spark.createDataFrame([('  a "q" b ', "x,y")], "name string, other string")
    landing.write_csv(report.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text == 'name,other\n"  a ""q"" b ","x,y"\n'


def test_county_outlines(spark, tmp_path):
    ring = [[-1.0, 2.0], [-1.0, 3.0], [0.0, 2.0], [-1.0, 2.0]]
    doc = {
        "type": "FeatureCollection",
        "features": [
            {
                "type": "Feature",
                "properties": {"FIPS": f"1900{i}", "COUNTY": f"C{i}"},
                "geometry": {"type": "Polygon", "coordinates": [ring]},
            }
            for i in (1, 3)
        ],
    }
    path = write(tmp_path, "c.geojson", json.dumps(doc, indent=1))
    rows = landing.read_counties(spark, path).orderBy("fips").collect()
    assert [(r.fips, r.county) for r in rows] == [("19001", "C1"), ("19003", "C3")]
    assert rows[0].polygon == [ring]
