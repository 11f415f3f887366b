"""Readers that tell what they reject, routes by course, and reads over several connections."""

import datetime as dt
import uuid
from collections import Counter

import pytest

from stridelake.sources import tables


def put(tmp_path, **files):
    for name, text in files.items():
        stem, _, ending = name.rpartition("_")
        (tmp_path / f"{stem}.{ending}").write_text(text)
    return f"file://{tmp_path}"


def test_routes_take_running_and_winning_lines_only(spark, tmp_path):
    mark = lambda name, text: f"<Placemark><name>{name}</name><LineString><coordinates>{text}</coordinates></LineString></Placemark>"
    at = put(
        tmp_path,
        north_ab_kml=f"<kml><Document>{mark('RAIL_FENCE', '0,0 1,1')}{mark('Main Running_Line', '1,2,0 3,4,0')}<Folder>{mark('winning_line', '5,6')}</Folder>{mark('WINNING POST', '7,7')}</Document></kml>",
        old_ab_kml=f"<kml>{mark('running_line', '9,9')}</kml>",
        cd_kml=f"<kml>{mark('RUNNING_LINE', '1,1 2,2')}<Placemark><name>WINNING_LINE</name><Point><coordinates>1,1</coordinates></Point></Placemark></kml>",
        zz_kml=f"<kml>{mark('RUNNING_LINE', '1,1')}</kml>",
    )
    rows = {(r["course_cd"], r["line_type"]): (r["file_name"], [tuple(p) for p in r["line"]]) for r in tables.read_routes(spark, at).collect()}
    assert rows.keys() == {("AB", "RUNNING_LINE"), ("AB", "WINNING_LINE"), ("CD", "RUNNING_LINE"), ("ZZ", "RUNNING_LINE")}
    assert rows["AB", "RUNNING_LINE"] == ("old_ab.kml", [(9.0, 9.0)]) and rows["AB", "WINNING_LINE"][1] == [(5.0, 6.0)]
    named = tables.read_routes(spark, at, {"AB": "KEE", "CD": "XXX"}).select("course_cd").distinct().collect()
    assert [r[0] for r in named] == ["KEE"]


def test_feeds_with_broken_files_and_records(spark, tmp_path):
    at = put(
        tmp_path,
        good_json='[{"I":"a","V":1.5},{"I":"b","V":2}]', cut_json='[{"I":"c","V":1.5},{"I":"d","V":', type_json='[{"I":"e","V":"abc"},{"I":"f","V":3}]',
        empty_json="", none_json="[]", word_json="hello", odd_json='[7,{"V":1},null,{"I":"g","V":4}]',
    )
    good, bad = tables.read_json_feed_checked(spark, at, "gps")
    assert sorted((r["id"], r["speed"], r["file_name"]) for r in good.collect()) == [("a", 1.5, "good.json"), ("b", 2.0, "good.json"), ("f", 3.0, "type.json"), ("g", 4.0, "odd.json")]
    seen = Counter((r["file_name"], r["reason"]) for r in bad.collect())
    assert seen == {("cut.json", "no array"): 1, ("word.json", "no array"): 1, ("type.json", "malformed"): 1, ("none.json", "no rows"): 1, ("empty.json", "no rows"): 1, ("odd.json", "malformed"): 1, ("odd.json", "no id"): 1, ("odd.json", "no rows"): 1}
    assert good.columns == tables.read_json_feed(spark, at, "gps").columns


def test_cards_with_broken_records(spark, tmp_path):
    card = lambda n, tail="</track>": f"<racedata><race>{n}</race><track>t{tail}</racedata>"
    at = put(tmp_path, good_xml=f"<cards>{card(1)}{card(2)}</cards>", bad_xml=f"<cards>{card('x')}{card(4)}{card(5, '</race></track>')}</cards>", cut_xml=f"<cards>{card(6)}<racedata><race>7</ra", none_xml="<cards></cards>", empty_xml="")
    got = tables.read_xml_cards(spark, at, strict=True)
    assert sorted(r["race"] for r in got["races"].collect()) == [1, 2, 4, 6]
    assert got["races"].count() == 4
    rejects = Counter((r["file_name"], r["reason"]) for r in got["rejects"].collect())
    assert rejects == {("bad.xml", "malformed"): 2, ("cut.xml", "malformed"): 1, ("none.xml", "no rows"): 1, ("empty.xml", "no rows"): 1}
    assert "rejects" not in tables.read_xml_cards(spark, at)


@pytest.mark.parametrize("column", ["ID", "DAY", "MOMENT", "PRICE", "SAME"])
def test_a_split_read_loses_no_row_of_null_or_busy_values(spark, column):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = [(None if k % 7 == 0 else 5 if k % 2 else k * 1000, dt.date(2024, 1, 1 + k % 9) if k % 5 else None, dt.datetime(2024, 1, 1, 0, 0, 0, k % 3 * 1000), k / 3, 1, k) for k in range(200)]
    spark.createDataFrame(rows, "ID long, DAY date, MOMENT timestamp, PRICE double, SAME int, K int").write.format("jdbc").option("url", url).option("dbtable", "T").mode("append").save()
    got = tables.split_read(spark, "SELECT * FROM T WHERE K < 190", url, column, 4)
    assert sorted(r["K"] for r in got.collect()) == list(range(190))
    sizes = got.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert column == "SAME" or len(sizes) >= 3
    if column == "ID":
        # The busy value has a range of its own; the rest is dealt out.
        assert max(sizes) <= 190 * 0.6 and len([n for n in sizes if n]) >= 4
    assert tables.split_read(spark, "SELECT * FROM T WHERE K < 0", url, column, 4).count() == 0


def test_a_reject_shows_its_record_and_stores_no_more(spark, tmp_path):
    cards = "".join(f"<racedata><race>{k}</race><track>t{k}</track></racedata>" for k in range(200))
    bad = ["<racedata><race>no</race></racedata>", "<racedata><race>7</race><track>t</race></track></racedata>"]
    at = put(tmp_path, long_xml=f"<cards>{cards}{bad[0]}{cards}{bad[1]}</cards>")
    got = tables.read_xml_cards(spark, at, strict=True)
    assert got["races"].count() == 400
    assert sorted(r["record"] for r in got["rejects"].collect()) == sorted(bad)


def test_odd_cards_are_read_or_rejected_as_the_reader_does(spark, tmp_path):
    one = "<racedata><race>1</race><track>t</track></racedata>"
    texts = {
        "spaces": f"<cards><racedata\nid='a>b' ><race>2</race></racedata\n>{one}</cards>", "empty": f"<cards><racedata/>{one}<racedata /></cards>",
        "cdata": f"<cards>{one}<racedata><race>2</race><track><![CDATA[a <b> </racedata> c]]></track></racedata>{one}</cards>",
        "comments": f"<cards><!-- {one} --><racedata><!-- </racedata> --><race>2</race></racedata>{one}</cards>", "names": f"<cards><racedatax>9</racedatax>{one}<RACEDATA/></cards>",
        "nested": f"<cards><racedata><race>2</race><x>{one}</x></racedata>{one}</cards>", "open": f"<cards>{one}<racedata><race>2</race>{one}{one}</cards>",
        "cut": f"<?xml version='1.0'?><cards>{one}<racedata><race>2</race><track>\u00e9</track>", "entity": f"<cards><racedata><race>1</race><track>a &amp; &#233;\u00e9</track></racedata>{one}</cards>", "quote": f"<cards>{one}<racedata id='1><race>2</race></racedata></cards>",
    }
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.xml").write_text(text)
        at = f"file://{tmp_path}/{name}"
        got = tables.read_xml_cards(spark, at, strict=True)
        kept = spark.read.format("xml").option("rowTag", "racedata").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", tables.BAD).schema(f"race int, track string, {tables.BAD} string").load(at).collect()
        rows = lambda found: sorted([(r["race"], r["track"]) for r in found], key=str)
        assert rows(got["races"].collect()) == rows([r for r in kept if r[tables.BAD] is None]), name
        assert got["rejects"].count() == len([r for r in kept if r[tables.BAD] is not None]), name
    # A tag that is not closed at the end of a text, a comment without its end, an end too many, and bytes that are no UTF-8.
    assert [*tables.cut_records(b"<c><r", "r")] == [] and [*tables.cut_records(b"<c><r/><r", "r")] == [b"<r/>"]
    assert [*tables.cut_records(b"<c><r>1</r><!-- <r>2</r></c>", "r")] == [b"<r>1</r>", b"<!-- <r>2</r></c>"]
    assert [*tables.cut_records(b"<c></r><r>\xff</r></r><r>2</r></c>", "r")] == [b"<r>\xff</r>", b"<r>2</r>"]
