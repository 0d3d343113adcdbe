import json
import xml.etree.ElementTree as ET

from quireflow.config import TAG_LABELS
from quireflow.sources.images import first_images, with_truth
from quireflow.sources.page_sink import append_metrics, page_xml, recognition_json, region_rows
from quireflow.sources.page_xml import page_lines, page_regions, page_tags, read_pages
from quireflow.streaming.flush import flush_metrics

PAGE = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"><Page imageFilename="a.jpg" imageWidth="100" imageHeight="50">
<TextRegion id="r0" orientation="1.5"><Coords points="0,0 9,0 9,9"/>
<TextLine id="l0" custom="readingOrder {index:0;}"><Coords points="0,0"/><Baseline points="1,1"/><TextEquiv><Unicode>Hanoi!</Unicode></TextEquiv></TextLine>
<TextLine id="l1" custom="readingOrder {index:1;} Sex {offset:0; length:1;} Geo_Town {offset:2; length:3; Geonames:4711;}"><TextEquiv><Unicode>&#9792; 8.II.1911</Unicode></TextEquiv></TextLine>
<TextLine id="l2"><TextEquiv><Unicode>x</Unicode></TextEquiv></TextLine>
<TextEquiv><Unicode>old</Unicode></TextEquiv><TextEquiv><Unicode>new</Unicode></TextEquiv></TextRegion>
<TextRegion id="r1"><Coords points="1,1 2,2"/></TextRegion>
<TextRegion id="r2"><Coords points="1,1 2,2"/><TextLine id="m"><TextEquiv><Unicode>only line</Unicode></TextEquiv></TextLine></TextRegion>
<TextRegion id="r3"><TextLine id="m"><TextEquiv><Unicode>earlier</Unicode></TextEquiv></TextLine><TextLine id="n"/></TextRegion>
</Page></PcGts>"""


def test_page_reader(spark, tmp_path):
    (tmp_path / "a.xml").write_text(PAGE)
    pages = read_pages(spark, str(tmp_path)).cache()
    p = pages.first()
    assert (p.image_name, p.image_filename, p.width, p.height) == ("a", "a.jpg", 100, 50)
    regions = page_regions(pages).orderBy("region_idx").collect()
    assert [(r.region_id, r.text, r.polygon and len(r.polygon)) for r in regions] == [("r0", "new", 3), ("r1", "", 2), ("r2", "only line", 2), ("r3", "earlier", None)]
    lines = page_lines(pages)
    assert [(r.line_id, r.text, [a.tag for a in r.attrs]) for r in lines.where("region_idx = 0").orderBy("line_idx").collect()] == [
        ("l0", "Hanoi!", ["readingOrder"]), ("l1", "♀ 8.II.1911", ["readingOrder", "Sex", "Geo_Town"]), ("l2", "x", [])]
    tags = page_tags(lines, TAG_LABELS).orderBy("start").collect()
    assert [(t.label, t.start, t.end, t.text, t.geoname_id) for t in tags] == [("Sex", 8, 9, "♀", None), ("Geo_Town", 10, 13, "8.I", 4711)]


def test_listing_counts_other_files(spark):
    names = spark.createDataFrame([(n,) for n in ("b.txt", "a.JPG", "c.png", "d.tif")], "image_name string")
    assert [(r.image_name, r.image_index) for r in first_images(names, 3).orderBy("image_index").collect()] == [("a.JPG", 0), ("c.png", 2)]
    assert first_images(names, 0).count() == 3
    truth = spark.createDataFrame([("a", 7)], "image_name string, width int")
    assert {(r.image_name, r.width) for r in with_truth(names, truth).collect()} == {("a.JPG", 7), ("b.txt", None), ("c.png", None), ("d.tif", None)}


def test_outputs(spark, tmp_path):
    rows = [("i", 1, (0, 0, 2, 3), "two", []), ("i", 0, (5, 6, 7, 8), "one", [("Sex", 0, 1)])]
    df = spark.createDataFrame(rows, "image_name string, region_idx int, box struct<x:int,y:int,w:int,h:int>, text string, spans array<struct<label:string,start:int,end:int>>")
    xml = page_xml(df.selectExpr("*", "9 AS width", "8 AS height", "array(named_struct('text', 'x', 'label', 'L', 'geoname_ids', array(1L, 2L))) AS links")).first().xml
    ns = {"p": "http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"}
    found = ET.fromstring(xml).findall(".//p:TextRegion", ns)
    assert [r.get("id") for r in found] == ["TextRegion_0", "TextRegion_1"]
    assert found[0].find("p:TextLine", ns).get("custom") == "readingOrder {index:0;} Sex {offset:0; length:1;}"
    assert found[0].find("p:EntityLinking", ns).get("geoname_ids") == "[1, 2]" and found[1].find("p:TextEquiv/p:Unicode", ns).text == "two"
    read = json.loads(recognition_json(df.selectExpr("*", "4 AS image_index")).first().json)
    assert read == {"image_index": 4, "regions": [{"bbox": [5, 6, 7, 8], "text": "one"}, {"bbox": [0, 0, 2, 3], "text": "two"}]}
    append_metrics(df.select("image_name"), f"{tmp_path}/m", "run1")
    append_metrics(df.select("image_name"), f"{tmp_path}/m", "run2")
    assert spark.read.parquet(f"{tmp_path}/m").groupBy("run_id").count().count() == 2


def test_stream_flushes_cumulative_totals(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([("k", float(i))], "k string, v double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    query = flush_metrics(spark, f"{tmp_path}/in", "k string, v double", 2, f"{tmp_path}/out", f"{tmp_path}/cp", "k", "v")
    query.awaitTermination()
    r = spark.read.parquet(f"{tmp_path}/out").first()
    assert (r.n, r.total, r.batch) == (4, 6.0, 1)


def test_pages_shuffle_values_not_elements(spark):
    from quireflow.plans.queries import QUERIES

    plan = QUERIES["page_xml_out"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    collected = [line for line in plan.splitlines() if "collect_list(struct(region_idx" in line]
    assert collected and not any("TextRegion_" in line.split("AS rs#")[0] for line in collected)


def test_regions_are_assembled_without_moving_them_again(spark):
    """What numbers the regions deals them by image; tags, links and pages need no other exchange, and boxes are made after it."""
    import re

    from quireflow.plans.queries import QUERIES

    plan = QUERIES["page_xml_out"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\((.*?)#", plan)
    assert set(moved) == {"l_orderkey"} and len(moved) <= 3
    assert not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*Project[^\n]*struct\(x", plan)


def test_region_rows_keep_repeated_and_keyless_readings(spark):
    readings = spark.createDataFrame([("a", 0, "one"), ("a", 0, "again"), ("a", 1, "two"), (None, 0, "no image"), ("b", None, "no number")], "image_name string, region_idx int, text string")
    tags = spark.createDataFrame([("a", 0, "L", 3, 5), ("a", 0, "K", 1, 2), (None, 0, "M", 0, 1), ("b", None, "M", 0, 1), ("c", 0, "M", 0, 1)], "image_name string, region_idx long, label string, start int, end int")
    links = spark.createDataFrame([("a", 1, 1, "y", "P", [2]), ("a", 1, 0, "x", "P", [1]), (None, 0, 0, "z", "P", [3])], "image_name string, region_idx int, link_idx int, text string, label string, geoname_ids array<bigint>")
    out = region_rows(readings, tags, links)
    assert out.columns == ["image_name", "region_idx", "text", "spans", "links"] and out.schema["region_idx"].dataType.simpleString() == "int"
    got = {r.text: ([s.label for s in r.spans], [x.text for x in r.links]) for r in out.collect()}
    assert got == {"one": (["K", "L"], []), "again": (["K", "L"], []), "two": ([], ["x", "y"]), "no image": ([], []), "no number": ([], [])}
