import http.server
import json
import os
import struct
import threading
import xml.etree.ElementTree as ET

import numpy as np
import pytest

from quireflow.__main__ import arguments
from quireflow.config import Settings, env_file, load_settings, logger
from quireflow.flow import run, serve
from quireflow.functions.text import crop_source
from quireflow.operators import images
from quireflow.sources.debug_sink import write_debug
from quireflow.sources.gazetteer import service_gazetteer
from quireflow.sources.image_source import image_folder
from quireflow.sources.images import first_images, list_images, nth_file, read_images
from quireflow.sources.metric_sink import MetricSink
from quireflow.sources.page_sink import reset_metrics, write_files
from quireflow.sources.page_xml import read_pages
from quireflow.sources.runs import index_names, index_table, read_events, read_recognition, recognition_of

NS = {"p": "http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"}
TRUTH = """<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"><Page imageFilename="a.png" imageWidth="60" imageHeight="40">
<TextRegion id="r0"><Coords points="5,5 24,5 24,14 5,14"/><TextLine id="l" custom="Geo_Town {offset:0; length:4; Geonames:9;} Sex {offset:5; length:1;}"><TextEquiv><Unicode>Lima ♀</Unicode></TextEquiv></TextLine><TextEquiv><Unicode>Lima ♀</Unicode></TextEquiv></TextRegion>
<TextRegion id="r1"><Coords points="35,20 54,20 54,34 35,34"/><TextEquiv><Unicode>Holotype</Unicode></TextEquiv></TextRegion></Page></PcGts>"""


class Known:
    """Reads by a box's size, so that texts are known."""

    def read(self, image):
        return {(10, 20): "Lima ♀\n\n8.II.1911", (15, 20): " Holotypus "}[image.shape[:2]]


@pytest.fixture
def folder(tmp_path):
    os.makedirs(tmp_path / "images")
    os.makedirs(tmp_path / "truth")
    page = np.full((40, 60, 3), 20, np.uint8)
    page[5:15, 5:25] = page[20:35, 35:55] = 230
    (tmp_path / "images/a.png").write_bytes(images.encode_png(page))
    (tmp_path / "images/b.PNG").write_bytes(images.encode_png(page[:, ::-1]))
    (tmp_path / "images/notes.txt").write_text("no image")
    (tmp_path / "truth/a.xml").write_text(TRUTH)
    return tmp_path


@pytest.fixture
def settings(folder, monkeypatch):
    monkeypatch.setitem(images.RECOGNISERS, "known", Known)
    return Settings(image_path=str(folder / "images"), output_path=str(folder / "out"), truth_path=str(folder / "truth"), backend="known", rule_labels=("GatheringDate", "Sex", "Type"), least_area_share=0.0, evaluation=True, debug=True, max_images=0)


def test_whole_run(spark, folder, settings, caplog):
    gazetteer = spark.createDataFrame([("Lima", 0, 9), ("Lima", 1, 4)], "name string, rank int, geoname_id bigint")
    (folder / "images/sub").mkdir()
    (folder / "images/sub/a.png").write_bytes((folder / "images/b.PNG").read_bytes())
    (folder / "images/bad.png").write_bytes(b"no picture")
    done = run(spark, settings, gazetteer, "r1")
    assert done["run_id"] == "r1" and done["counts"]["listing"] == {"rows": 3, "failed": 0} and done["counts"]["decoded"] == {"rows": 2, "failed": 0}
    assert done["counts"]["without_truth"]["rows"] == 1 and done["counts"]["text"] == {"unequal": 0}
    assert [r.message for r in caplog.records if r.levelname == "ERROR"] == ["image bad.png failed in reading: cannot be read as an image"]
    assert [r.message for r in caplog.records if r.levelname == "WARNING" and r.name.startswith("quireflow")] == ["no ground truth for image b.PNG"]
    assert {n for n in os.listdir(folder / "out") if n.endswith(".xml")} == {"a.xml", "b.xml"}
    text = (folder / "out/a.xml").read_text()
    assert text.startswith('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<PcGts')
    page = ET.fromstring(text.encode()).find("p:Page", NS)
    assert (page.get("imageFilename"), page.get("imageWidth"), page.get("imageHeight")) == ("a.png", "60", "40")
    regions = page.findall("p:TextRegion", NS)
    assert [r.find("p:TextEquiv/p:Unicode", NS).text for r in regions] == ["Holotypus", "Lima ♀\n8.II.1911"]  # the larger one first
    assert regions[1].find("p:TextLine", NS).get("custom") == "readingOrder {index:1;} Sex {offset:5; length:1;} GatheringDate {offset:7; length:9;}"
    assert regions[0].find("p:Coords", NS).get("points") == "35,20 55,20 55,35 35,35"
    metric = lambda name: MetricSink(spark, f"{folder}/out/metrics", "r1").rows(name).collect()
    assert [(r.image_name, round(r.avg_iou, 6)) for r in metric("layout")] == [("a.png", 1.0)]
    # readings 'Holotypus' and 'Lima ♀ / 8.II.1911' serve the second and first true text
    assert sorted((r.image_name, r.bb_index, r.cer) for r in metric("text")) == [("a.png", 0, 10 / 6), ("a.png", 1, 2 / 8)]
    assert [(r.image_name, r.region_idx, r.tp, r.fp, r.fn) for r in metric("tags")] == [("a.png", 0, 1, 0, 1)]
    assert [(r.image_name, r.valid, r.tp, r.fp) for r in metric("links")] == [("a.png", True, 1, 0)]
    seen = {os.path.relpath(f"{d}/{n}", folder / "out/debug") for d, _, ns in os.walk(folder / "out/debug") for n in ns if n.endswith((".png", ".json"))}
    assert {"preprocessing/r1/a.png", "layout_analysis/r1/a_1.png", "layout_analysis/r1/a_2.png", "layout_analysis/r1/masks/a_mask0.png", "text_recognition/r1/a.json"} <= seen
    assert spark.read.parquet(f"{folder}/out/debug/samples").where("size(predictions) = 2 AND image_name = 'a.png'").count() == 1
    read = read_recognition(spark, f"{folder}/out/debug/text_recognition")
    assert {(r.image_index, r.image_name) for r in index_table(read).collect()} == {(0, "a"), (1, "b")}
    assert read.agg(index_names(read).alias("m")).first().m == {0: "a", 1: "b"}
    assert recognition_of(read, "a").first().regions[0].bbox == [35, 20, 20, 15]


def test_one_bad_image_does_not_stop_the_others(spark, folder, settings, monkeypatch):
    from quireflow.flow import extract

    small = spark.createDataFrame([("bad.png", 60, 40, 3, b"short")], "image_name string, width int, height int, n_channels int, data binary")
    good = read_images(spark, settings.image_path)
    found = extract(good.unionByName(small), spark.createDataFrame([], "name string, rank int, geoname_id bigint"), settings)
    assert [(r.image_name, r.stage) for r in found.errors.collect()] == [("bad.png", "preprocessing")]
    assert {r.image_name for r in found.pages.collect()} == {"a.png", "b.PNG"}


def test_served(spark, folder, settings, monkeypatch):
    from quireflow import flow

    gazetteer = spark.createDataFrame([], "name string, rank int, geoname_id bigint")
    seen, real = [], flow.extract
    monkeypatch.setattr(flow, "extract", lambda new, *a: (seen.append(sorted(r.image_name for r in new.select("image_name").collect())), real(new, *a))[1])
    pages = lambda: {n for n in os.listdir(folder / "out") if n.endswith(".xml")}
    serve(spark, settings, gazetteer, f"{folder}/state", once=True).awaitTermination()
    assert pages() == {"a.xml", "b.xml"}
    (folder / "images/c.png").write_bytes((folder / "images/a.png").read_bytes())
    (folder / "images/bad.png").write_bytes(b"no picture")
    serve(spark, settings, gazetteer, f"{folder}/state", once=True).awaitTermination()
    assert pages() == {"a.xml", "b.xml", "c.xml"} and seen == [["a.png", "b.PNG"], ["c.png"]]  # a batch's own files alone
    sink = MetricSink(spark, f"{folder}/out/metrics", "served")
    assert sink.commits() == [0, 1] and [(r.image_name, round(r.avg_iou, 6)) for r in sink.rows("layout").collect()] == [("a.png", 1.0)]


def test_a_limit_opens_so_many_files(spark, folder, settings, monkeypatch):
    from quireflow import flow

    for i in range(5):
        (folder / f"images/z{i}.png").write_bytes((folder / "images/a.png").read_bytes())
    opened, real = [], flow.read_images
    monkeypatch.setattr(flow, "read_images", lambda *a: (opened.append(real(*a).inputFiles()), real(*a))[1])
    done = run(spark, flow.Settings(**(settings.__dict__ | {"max_images": 2, "debug": False, "evaluation": False})), spark.createDataFrame([], "name string, rank int, geoname_id bigint"), "r2")
    assert [sorted(os.path.basename(f) for f in some) for some in opened] == [["a.png", "b.PNG"]]
    assert done["counts"]["decoded"]["rows"] == 2
    # the limit counts every file, the number is that among all
    names = [(r.image_name, r.image_index) for r in image_folder(spark, settings.image_path, 4).collect()]
    assert names == [("a.png", 0), ("b.PNG", 1), ("z0.png", 3)]
    assert [r.image_name for r in image_folder(spark, f"file://{folder}/images").collect()] == ["a.png", "b.PNG", "z0.png", "z1.png", "z2.png", "z3.png", "z4.png"]
    assert image_folder(spark, str(folder / "truth")).collect() == []


def test_an_untagged_first_region_is_the_one_that_counts(spark):
    from quireflow.flow import evaluate, Extraction

    page = """<?xml version="1.0"?><PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"><Page imageFilename="{0}" imageWidth="60" imageHeight="40">
<TextRegion id="r0"><Coords points="5,5 24,5 24,14"/><TextLine id="l"><TextEquiv><Unicode>plain ♂</Unicode></TextEquiv></TextLine></TextRegion>{1}</Page></PcGts>"""
    more = """<TextRegion id="r1"><Coords points="5,5 24,5 24,14"/><TextLine id="l" custom="Sex {offset:0; length:1;}"><TextEquiv><Unicode>♀</Unicode></TextEquiv></TextLine></TextRegion>"""
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        for name, text in (("a", more), ("b", "")):
            with open(f"{folder}/{name}.xml", "w", encoding="utf-8") as f:
                f.write(page.format(f"{name}.png", text))
        images = spark.createDataFrame([("a.png", 60, 40), ("b.png", 60, 40)], "image_name string, width int, height int")
        readings = spark.createDataFrame([("a.png", 0, None), ("a.png", 1, "♀"), ("b.png", 0, "plain ♂")], "image_name string, region_idx int, text string")
        segmented = spark.createDataFrame([("a.png", 60, 40, []), ("b.png", 60, 40, [])], "image_name string, width int, height int, masks array<struct<mask_idx:int,pixels:binary>>")
        found = Extraction(images, images, segmented, readings, None, None, None, None)
        got = evaluate(found, read_pages(spark, folder), spark.createDataFrame([], "name string, rank int, geoname_id bigint"), Settings())
        # neither first region has a tag: what is found there, or in the second one, is false
        assert sorted((r.image_name, r.region_idx, r.tp, r.fp, r.fn) for r in got["tags"].collect()) == [("a.png", 0, 0, 1, 0), ("a.png", 1, 0, 1, 0), ("b.png", 0, 0, 1, 0)]
        assert sorted((r.image_name, r.valid, r.tp, r.fp) for r in got["links"].collect()) == [("a.png", False, 0, 0), ("b.png", False, 0, 0)]
        # a reading that is null has read nothing
        assert sorted((r.image_name, r.bb_index, r.cer) for r in got["text"].collect()) == [("a.png", 0, 1.0), ("a.png", 1, 0.0), ("b.png", 0, 0.0)]


def test_listing(spark, folder):
    names = list_images(spark, str(folder / "images"))
    assert [(r.image_name, r.image_index) for r in first_images(names, 0).orderBy("image_index").collect()] == [("a.png", 0), ("b.PNG", 1)]
    assert nth_file(names, 0).first().image_name == "a.png" and nth_file(names, 1).first() is None
    df = spark.createDataFrame([("abc_01.crop.png",)], "n string")
    assert df.select(crop_source(df.n)).first()[0] == "abc_.jpg"


def record(data):
    return struct.pack("<Q", len(data)) + b"\0" * 4 + data + b"\0" * 4


def event(wall, step, tag=None, value=0.0):
    out = b"\x09" + struct.pack("<d", wall) + b"\x10" + bytes([step])
    if tag is not None:
        inner = b"\x0a" + bytes([len(tag)]) + tag.encode() + b"\x15" + struct.pack("<f", value)
        summary = b"\x0a" + bytes([len(inner)]) + inner
        out += b"\x2a" + bytes([len(summary)]) + summary
    return record(out)


def test_event_files(spark, tmp_path):
    os.makedirs(tmp_path / "run/sub")
    (tmp_path / "run/sub/events.out.tfevents.1").write_bytes(event(1.5, 0) + event(2.5, 3, "Text/_CER", 0.25) + event(3.5, 4, "Layout/_ious", 0.5) + b"cut off")
    (tmp_path / "run/other.txt").write_text("x")
    got = read_events(spark, str(tmp_path / "run")).orderBy("seq").collect()
    assert [(r.seq, r.wall_time, r.name, r.step, r.value) for r in got] == [(0, 2.5, "Text/_CER", 3, 0.25), (1, 3.5, "Layout/_ious", 4, 0.5)]


def test_recognition_files_without_an_index_are_left_out(spark, tmp_path):
    (tmp_path / "a.b.json").write_text(json.dumps({"image_index": 3, "regions": [{"bbox": [1, 2, 3, 4], "text": "x"}]}, indent=4))
    (tmp_path / "c.json").write_text("{}")
    (tmp_path / "d.txt").write_text("{}")
    assert [(r.image_name, r.image_index) for r in read_recognition(spark, str(tmp_path)).collect()] == [("a", 3)]


def test_service_gazetteer(spark):
    class Answers(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            ok = "Lima" in self.path and "username=me" in self.path
            self.send_response(200 if ok else 404)
            self.end_headers()
            if ok:
                self.wfile.write(json.dumps({"geonames": [{"geonameId": 9}, {"geonameId": 4}]}).encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    names = spark.createDataFrame([("Lima",), ("Lima",), ("Nowhere",), (None,)], "text string")
    got = service_gazetteer(names, f"http://127.0.0.1:{server.server_port}/search", "me").collect()
    server.shutdown()
    assert sorted((r.name, r.rank, r.geoname_id) for r in got) == [("Lima", 0, 9), ("Lima", 1, 4)]


def test_settings_come_from_files_and_variables(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"max_images": 7, "steps": ["gray"], "label_prefix": "X_"}))
    (tmp_path / ".env").write_text("# a comment\nexport QUIREFLOW_DEBUG='yes'\nQUIREFLOW_STEPS=gray, contrast\n\n")
    plain = load_settings(str(tmp_path / "s.json"), {})
    assert (plain.max_images, plain.steps, plain.labels(("Sex",)), plain.debug) == (7, ("gray",), ("X_Sex",), False)
    both = load_settings(None, env_file(str(tmp_path / ".env")) | {"QUIREFLOW_CONFIG": str(tmp_path / "s.json")})
    assert both.debug is True and both.steps == ("gray", "contrast") and both.max_images == 7
    assert load_settings(None, {}).development().max_images == 5
    with pytest.raises(ValueError):
        plain.updated({"nothing": 1})
    assert arguments(["--max-images", "3", "--serve-deployment"]).max_images == 3
    assert logger("x", "r").extra == {"run_id": "r"}


def test_a_run_begins_its_metrics_anew(spark, tmp_path):
    for run_id, values in (("a", [1, 2]), ("b", [3]), ("a", [4])):
        reset_metrics(spark.createDataFrame([(v,) for v in values], "v int"), f"{tmp_path}/m", run_id)
    assert sorted((r.run_id, r.v) for r in spark.read.parquet(f"{tmp_path}/m").collect()) == [("a", 4), ("b", 3)]
    write_files(spark.createDataFrame([("x/a.txt", "ä")], "name string, content string"), f"{tmp_path}/files")
    assert os.listdir(f"{tmp_path}/files/x") == ["a.txt"] and open(f"{tmp_path}/files/x/a.txt").read() == "ä"
    with pytest.raises(ValueError):
        write_debug(None, None, "", "", "r")
