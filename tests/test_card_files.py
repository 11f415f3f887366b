"""Card files grow in bytes and not in number, and are parsed once."""

import glob

from pyspark.sql import functions as F

from stridelake.plans import q_sources
from stridelake.sources import tables
from stridelake.sources.shared import folder


def test_lines_make_a_few_files_with_one_root_each(spark):
    at = folder(spark, "lines")
    card = F.concat(F.lit("<racedata><race>"), F.col("id").cast("string"), F.lit("</race></racedata>"))
    q_sources.write_lines(spark.range(30_000), at, "<cards>", card, "</cards>")
    files = glob.glob(at.removeprefix("file://") + "/part-*")
    assert 1 <= len(files) <= 8
    texts = [open(f).read() for f in files]
    assert all(t.startswith("<cards>\n") and t.endswith("</cards>\n") and t.count("<cards>") == 1 for t in texts)
    got = tables.read_xml_cards(spark, at)["races"]
    assert got.agg(F.count("race"), F.sum("race")).head() == (30_000, sum(range(30_000)))


def test_tables_of_cards_read_stored_rows(spark, tmp_path):
    (tmp_path / "card.xml").write_text("<cards><racedata><track>AB</track><race>1</race></racedata><racedata><race>x</race></racedata></cards>")
    for strict in (False, True):
        for name, frame in tables.read_xml_cards(spark, f"file://{tmp_path}", strict=strict).items():
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Format: XML" not in plan and "FileScan xml" not in plan, name


def test_packed_lines_are_gzipped_where_they_are_and_read_back(spark):
    at = folder(spark, "packed")
    card = F.concat(F.lit("<racedata><race>"), F.col("id").cast("string"), F.lit("</race></racedata>"))
    q_sources.write_lines(spark.range(0, 30_000, 1, 3), at, "<cards>", card, "</cards>", packed=True)
    files = glob.glob(at.removeprefix("file://") + "/part-*")
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    got = tables.read_xml_cards(spark, at)["races"]
    assert got.agg(F.count("race"), F.sum("race")).head() == (30_000, sum(range(30_000)))


def test_cards_of_children_are_packed(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(q_sources, "folder", lambda s, name: kept.append(folder(s, name)) or kept[-1])
    next(f for f in q_sources.QUERIES["k6_card_children"] if callable(f))(spark, "/root/testdata/sf0.001")
    files = glob.glob(kept[0].removeprefix("file://") + "/part-*")
    assert files and all(f.endswith(".gz") for f in files)
