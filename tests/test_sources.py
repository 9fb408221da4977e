"""Logger exports of several makers, encodings and shapes."""

import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from agrolith.functions import expressions as X
from agrolith.functions import names
from agrolith.sources import logger_files as L
from agrolith.sources import parsing


def xlsx(path, sheets):
    """A small workbook; floats under the key ``date`` carry a date style."""
    styles = '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>'
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/styles.xml", styles)
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for n, row in enumerate(rows, 1):
                cells = ""
                for j, v in enumerate(row):
                    ref = f"{chr(65 + j)}{n}"
                    if isinstance(v, datetime):
                        cells += f'<c r="{ref}" s="1"><v>{(v - datetime(1899, 12, 30)).total_seconds() / 86400!r}</v></c>'
                    elif isinstance(v, (int, float)):
                        cells += f'<c r="{ref}"><v>{v}</v></c>'
                    elif v:
                        cells += f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
                body += f'<row r="{n}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


@pytest.mark.parametrize("name, var", [
    ("°C Air Temperature", "temp"), ("AirTemp", "temp"), ("기온", "temp"), ("온도(℃)", "temp"), ("외부온도", "temp"), ("% Relative Humidity", "rh"), ("상대습도(%)", "rh"), ("RH", "rh"),
    ("SoilTemp", "soil_temp"), ("soil_temp", "soil_temp"), ("배지 온도", "soil_temp"), ("% Water Content", "vwc"), ("배지습도", "vwc"), ("µmol·m⁻²·s⁻¹ PPFD", "ppfd"), ("PAR", "ppfd"), ("parameter", None),
    ("W/m² Solar Radiation", "solar"), ("일사량", "solar"), ("mS/cm Saturation Extract EC", "ec"), ("급액EC", None), ("CO2 (ppm)", "co2"), ("°C Logger Temperature", None), ("% Battery Percent", None), ("수온", None), ("pH", None),
])
def test_variables(name, var):
    assert names.variable_of(name) == var


@pytest.mark.parametrize("file, serial", [("260703_22094002.csv", "22094002"), ("z6-03959_2026.xlsx", "z6-03959"), ("PAR1-22070169_x.csv", "PAR1-22070169"), ("3fa9c1-z6-20917.xlsx", "z6-20917"), ("20260703_7.csv", "20260703"), ("구역A_1.xlsx", "구역A"), ("22094002.csv", "22094002")])
def test_serials_of_files(file, serial):
    assert names.serial_of_file(file) == serial


def test_sheets():
    assert names.sheets(["Metadata", "Processed Data Config 1", "Processed Data Config 2", "Raw Data"]) == ["Processed Data Config 1", "Processed Data Config 2"]
    assert names.sheets(["Metadata", "Raw 1"]) == ["Raw 1"] and names.sheets(["Metadata"]) == ["Metadata"]


def test_plain_names():
    assert names.sanitised("m/s Wind Speed (avg)") == "wind_speed" and names.sanitised("(%)") == "col"
    assert [c["channel"] for c in names.channels(["pH", "pH ", "temp"], {"pH": True, "pH ": True, "temp": True})] == ["temp", "ph", "ph_2"]
    assert sorted(["vwc__rep10", "vwc__rep2", "co2", "temp", "zz"], key=names.column_order) == ["temp", "vwc__rep2", "vwc__rep10", "co2", "zz"]


def test_time_stamps(spark):
    cases = {"2026-04-01 10:20:30": datetime(2026, 4, 1, 10, 20, 30), "2026/04/01 10:20": datetime(2026, 4, 1, 10, 20), "05. 19. 25 오후 05시 30분 01초": datetime(2025, 5, 19, 17, 30, 1), "2026.04.01 오전 09시 05분 00초": datetime(2026, 4, 1, 9, 5), "junk": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", X.parse_time(F.col("t")).alias("ts"))
    assert {r.t: r.ts for r in df.collect()} == cases


def test_cells_and_errors(spark):
    cases = {"1.5": (1.5, False), " 2 ": (2.0, False), "1e3": (1000.0, False), "": (None, False), "-": (None, False), "NaN": (None, False), "ERROR": (None, True), "inf": (None, True), "1.5d": (None, True), "#VALUE!": (None, True), "12 x": (None, True)}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string").select("t", X.number(F.col("t")).alias("v"), X.is_error(F.col("t")).alias("e"))
    assert {r.t: (r.v, r.e) for r in df.collect()} == cases | {None: (None, False)}


def test_csv_of_korean_logger_and_broken_file(spark, tmp_path):
    lines = ["차트 제목: 22094002", "", '#,일시,"온도(℃)","상대습도(%)",비고']
    lines += [f'{i + 1},05. 19. 25 오후 0{1 + i // 60}시 {i % 60:02d}분 00초,{20 + i * 0.1:.1f},{"ERROR" if i == 3 else 50},메모' for i in range(120)]
    (tmp_path / "260703_1.csv").write_bytes("\n".join(lines).encode("cp949"))
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    found = L.cells(spark, str(tmp_path))
    assert [r.file for r in L.problems(found).collect()] == ["bad.xlsx"]
    read = L.readings(found)
    assert read.count() == 240 and read.where("is_error").count() == 1
    first = read.where("channel = 'temp'").orderBy("ts").first()
    assert (first.serial, first.ts, first.value) == ("22094002", datetime(2025, 5, 19, 13), 20.0)


def test_workbook_with_ports_and_split_configuration(spark, tmp_path):
    t = [datetime(2026, 4, 1, i // 6, 10 * (i % 6)) for i in range(144)]
    one = [["z6-03959", "Port 1", "Port 2", "Port 3"], ["144 records", "TEROS", "TEROS", "ATMOS"], ["Timestamp", "% Water Content", "% Water Content", "°C Air Temperature"]] + [[x, 0.0, 30 + i % 5, 20 + i % 7] for i, x in enumerate(t)]
    two = [["z6-03959", "Port 1"], ["", "x"], ["Timestamp", "µmol·m⁻²·s⁻¹ PPFD"]] + [[x, 100 + i % 9] for i, x in enumerate(t)]
    xlsx(tmp_path / "z6.xlsx", {"Processed Data Config 1": one, "Processed Data Config 2": two, "Raw Data": two, "Metadata": [["x"]]})
    read = L.readings(L.cells(spark, str(tmp_path / "z6.xlsx")))
    counts = {r.channel: r["count"] for r in read.groupBy("channel").count().collect()}
    assert counts == {"vwc__rep1": 144, "vwc__rep2": 144, "temp": 144, "ppfd": 144}
    assert read.select("serial", "model").distinct().collect() == [("z6-03959", "METER ZL6")]
    assert read.agg(F.max("ts")).first()[0] == t[-1]


def test_split_date_and_time_semicolons_and_overrides(spark, tmp_path):
    rows = ["날짜;시각;온도(℃);pH;쓸모없음"] + [f"2026-04-01;{i // 60:02d}:{i % 60:02d};{20 + i % 3};6.{i % 10};{i}" for i in range(300)]
    (tmp_path / "L1234.txt").write_text("\n".join(rows), encoding="utf-8-sig")
    read = L.readings(L.cells(spark, str(tmp_path), {"쓸모없음": "exclude"}))
    assert {r.channel for r in read.select("channel").distinct().collect()} == {"temp", "ph"}
    assert L.deduplicated(read.withColumn("row", F.lit(0))).count() == 600


def test_ragged_and_names():
    assert parsing.ragged("a\tb\n1\t2\t3\n\n") == [["a", "b", ""], ["1", "2", "3"]]
    assert parsing.column_names([["", "Port 1", "Port 1"], ["x", "", ""], ["Timestamp", "T", "T"]], 2) == ["Timestamp", "Port1 T", "Port1 T.1"]
    assert parsing.time_columns(["v"], [["1"], ["2"]]) is None


def test_growth_needs_its_date(spark, tmp_path):
    (tmp_path / "g.csv").write_text("date,trt,height\n2026-04-10,a,1.5\n2026-04-20,b,x\n")
    assert [(str(r.date), r.height) for r in L.growth(spark, f"{tmp_path}/g.csv").orderBy("date").collect()] == [("2026-04-10", 1.5), ("2026-04-20", None)]
    with pytest.raises(ValueError):
        L.growth(spark, f"{tmp_path}/g.csv", "day")
