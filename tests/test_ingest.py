import zlib
from pathlib import Path

import numpy as np

from leafmill import cli
from leafmill.operators import reads
from leafmill.operators.store import Store
from leafmill.plans.ingest import Config, run
from leafmill.sources import files, pdf
from leafmill.state import read_state, write_state
from leafmill.streaming.ingest import start

LINE = "The annual ledger of the harbour office lists 31,250 units of stock and 4,120 of freight."


def make_pdf(pages, rotate=0, deflate=True):
    """A small PDF; a page is its lines, or None for a damaged content stream."""
    objects, kids = {1: b"<< /Type /Catalog /Pages 2 0 R >>"}, []
    for i, lines in enumerate(pages):
        page, content = 3 + 2 * i, 4 + 2 * i
        kids.append(b"%d 0 R" % page)
        objects[page] = b"<< /Type /Page /Parent 2 0 R /Rotate %d /Contents %d 0 R >>" % (rotate, content)
        if lines is None:
            objects[content] = b"<< /Filter /FlateDecode /Length 3 >>\nstream\nxyz\nendstream"
            continue
        escaped = [x.encode("cp1252").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") for x in lines]
        data = b"BT /F1 12 Tf " + b" T* ".join(b"(" + x + b") Tj" for x in escaped) + b" ET"
        data, kind = (zlib.compress(data), b"/Filter /FlateDecode ") if deflate else (data, b"")
        objects[content] = b"<< " + kind + b"/Length %d >>\nstream\n" % len(data) + data + b"\nendstream"
    objects[2] = b"<< /Type /Pages /Kids [" + b" ".join(kids) + b"] /Count %d >>" % len(kids)
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % (k, v) for k, v in sorted(objects.items())) + b"\n%%EOF"


def test_reader():
    got = list(pdf.read_pages(make_pdf([["one (1)", "two"], None, []], rotate=90)))
    assert got[0] == (1, "one (1)\ntwo", 90, None, None) and got[1][3] and got[2][1] is None
    for bad in (b"nothing", b"%PDF-1.4\n"):
        try:
            list(pdf.read_pages(bad))
            raise AssertionError
        except pdf.UnreadablePDF:
            pass


def test_fonts_and_object_streams():
    # the page tree in an object stream; a font of two bytes with its map, one of one byte with ranges; resources from the parent
    cmap = b"/CIDInit begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0003> <0020> <0010> <0645> endbfchar 1 beginbfrange <0011> <0012> <0631> endbfrange 1 beginbfrange <0020> <0021> [<062D> <06280627>] endbfrange endcmap"
    simple = b"1 begincodespacerange <00> <FF> endcodespacerange 1 beginbfrange <41> <43> <0061> endbfrange"
    inner = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [3 0 R] /Count 1 /Resources << /ProcSet [/PDF] /Font << /F1 5 0 R /F2 6 0 R >> >> >>", 3: b"<< /Type /Page /Parent 2 0 R /Contents [4 0 R] >>"}
    bodies, head, at = b"", [], 0
    for k, v in inner.items():
        head += [k, len(bodies)]
        bodies += v + b" "
    first = " ".join(map(str, head)).encode() + b" "
    packed = zlib.compress(first + bodies)
    content = zlib.compress(b"BT /F1 12 Tf 1 0 0 1 50 700 Tm <0010001100200021> Tj 1 0 0 1 90 700 Tm <00100003> Tj 0 -14 Td /F2 9 Tf [(AB) -30 (C) -400 (A)] TJ 20 0 Td (B) Tj ET")
    objects = {
        4: b"<< /Filter /FlateDecode >>\nstream\n" + content + b"\nendstream", 5: b"<< /Type /Font /Subtype /Type0 /ToUnicode 7 0 R >>", 6: b"<< /Type /Font /Subtype /TrueType /ToUnicode 8 0 R >>",
        7: b"<< >>\nstream\n" + cmap + b"\nendstream", 8: b"<< >>\nstream\n" + simple + b"\nendstream", 9: b"<< /Type /ObjStm /N 3 /First %d /Filter /FlateDecode >>\nstream\n" % len(first) + packed + b"\nendstream",
    }
    data = b"%PDF-1.5\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % x for x in objects.items())
    assert [p[:4] for p in pdf.read_pages(data)] == [(1, "مرحبا م \nabc a b", 0, None)]
    try:
        list(pdf.read_pages(data + b"trailer << /Encrypt 10 0 R >>"))
        raise AssertionError
    except pdf.UnreadablePDF as e:
        assert str(e) == "encrypted"


def inbox(folder: Path):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "a.pdf").write_bytes(make_pdf([[LINE], [LINE, "second"]]))
    (folder / "copy of a+b.PDF").write_bytes(make_pdf([[LINE], [LINE, "second"]]))
    (folder / "partial.pdf").write_bytes(make_pdf([[LINE, "x"], None]))
    (folder / "broken.pdf").write_bytes(b"%PDF-1.4 nothing")
    (folder / "notes.txt").write_text("no")
    return str(folder)


def test_run_and_second_run(spark, tmp_path):
    box = inbox(tmp_path / "in")
    manifest = tmp_path / "m.json"
    manifest.write_text('{"a.pdf": {"source_label": "Harbour", "source_url": null}}')
    config = Config(box, f"file://{tmp_path}/seen", f"file://{tmp_path}/store", f"file://{manifest}", dimension=8)
    r = run(spark, config).first()
    assert (r.processed_delta, r.failed_delta, r.page_failures_delta, r.documents_written_delta, r.pages_written_delta) == (1, 2, 1, 2, 3)
    kept = Store(spark, config.store)
    docs = {d.file_name: d for d in reads.list_documents(kept.read("documents"), kept.read("pages")).collect()}
    assert docs["a.pdf"].source_label == "Harbour" and docs["a.pdf"].page_count == 2 and docs["partial.pdf"].page_count == 1
    assert {(e.stage, e.page_id) for e in spark.read.parquet(f"{config.store}/errors").collect()} == {("read", None), ("read", "partial.pdf-2")}
    assert r.failed_pages == "partial.pdf:1[2]" and r.current_status == "failed"
    # scratch tables are gone
    assert not any((tmp_path / "store" / "scratch").rglob("*.parquet"))
    page = kept.read("pages").where("page_number = 2").first()
    assert (page.extraction_method, page.text_content.endswith("second")) == ("text_layer", True)
    # the whole document is seen now; the others are tried again, to the same rows
    r = run(spark, config).first()
    assert (r.processed_delta, r.failed_delta) == (0, 2)
    assert kept.read("documents").count() == 2 and kept.read("embeddings").count() == 3


def test_recognition_only_where_it_is_needed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "scan.pdf").write_bytes(make_pdf([[], [LINE]]))
    asked = []

    def recogniser(pages):
        asked.extend(r.page_id for r in pages.collect())
        return spark.createDataFrame([("scan.pdf-1", 0, 180, LINE + " recognised", 0.9)], "page_id string, orientation int, dpi int, text string, confidence double")

    config = Config(str(folder), f"file://{tmp_path}/seen", f"file://{tmp_path}/store", recogniser=recogniser)
    assert run(spark, config).first().processed_delta == 1
    assert asked == ["scan.pdf-1"]
    assert {r.extraction_method for r in Store(spark, config.store).read("pages").collect()} == {"text_layer", "vision_ocr"}


def test_the_deadline_ends_a_run_between_batches(spark, tmp_path, monkeypatch):
    folder = inbox(tmp_path / "in")
    (tmp_path / "in" / "z.pdf").write_bytes(make_pdf([[LINE, "last"]]))
    config = Config(folder, f"file://{tmp_path}/seen", f"file://{tmp_path}/store", batch_documents=1, timeout_seconds=100)
    clock = iter([0, 0, 50, 100, 150])
    monkeypatch.setattr("leafmill.plans.ingest.time.monotonic", lambda: next(clock))
    told = []
    r = run(spark, config, progress=told.append).first()
    # two batches of one document each, in the order of names
    assert (r.processed_delta, r.failed_delta, r.pages_written_delta) == (1, 1, 2)
    assert [t["current_item"]["status"] for t in told] == ["in_progress", "processed", "in_progress", "failed"] and told[1]["counts"]["processed_delta"] == 1
    assert {d.source_filename for d in Store(spark, config.store).read("documents").collect()} == {"a.pdf"}
    monkeypatch.undo()
    assert run(spark, Config(**{**config.__dict__, "timeout_seconds": 0})).first().processed_delta == 0
    r = run(spark, Config(**{**config.__dict__, "timeout_seconds": None})).first()
    assert (r.processed_delta, r.failed_delta) == (1, 2) and r.failed_pages == "partial.pdf:1[2]"


def test_plugs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(make_pdf([[LINE], [LINE + " bad vector"]]))
    written, logged = [], []
    config = Config(
        str(folder), f"file://{tmp_path}/seen", f"file://{tmp_path}/store", dimension=3, embedder=lambda t: np.array([1, 2, np.nan if "bad" in t else 3], np.float32),
        writer=lambda rows, dimension: written.extend(rows.collect()), error_logger=lambda errors: logged.extend(errors.collect()),
    )
    r = run(spark, config, run_id=5).first()
    # an invalid vector fails its page, and so the document
    assert (r.processed_delta, r.failed_delta, r.page_failures_delta, r.failed_pages) == (0, 1, 1, "a.pdf:1[2]")
    assert [w.page_number for w in written] == [1] and [(e.run_id, e.stage, e.reason_code, e.page_id) for e in logged] == [(5, "embedding", "invalid_value", "a.pdf-2")]


def test_scans_are_recognised_with_their_languages(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    scan = make_pdf([[]]).replace(b"/Rotate 0", b"/Rotate 0 /Resources << /XObject << /Im0 90 0 R >> >>").replace(b"%%EOF", b"90 0 obj\n<< /Subtype /Image /Filter /DCTDecode /Length 7 >>\nstream\nJPEGJPE\nendstream\nendobj\n%%EOF")
    (folder / "scan.pdf").write_bytes(scan)
    seen = spark.sparkContext.accumulator(0)

    def read(image, orientation, dpi, languages):
        ok = image == b"JPEGJPE" and languages == ["de", "ar"]
        seen.add(1)
        return ([LINE, "read"], [0.9, 0.7]) if ok and orientation == 0 else ([], [])

    config = Config(str(folder), f"file://{tmp_path}/seen", f"file://{tmp_path}/store", languages=("de", "ar"), recogniser=lambda pages: pdf.recognise(pages, read, [(0, 180), (0, 320)]))
    assert run(spark, config).first().processed_delta == 1
    page = Store(spark, config.store).read("pages").first()
    assert page.extraction_method == "vision_ocr" and page.confidence == 0.8 and page.text_content.endswith("read")


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from pyspark.sql import SparkSession

    monkeypatch.setattr(SparkSession.Builder, "getOrCreate", lambda self: spark)
    args = ["--inbox", inbox(tmp_path / "in"), "--seen-file", f"file://{tmp_path}/seen", "--db-path", f"file://{tmp_path}/store", "--state-file", str(tmp_path / "state.json")]
    assert cli.main(args) == cli.OK
    line, status = capsys.readouterr().out.strip().split("\n")[-2:]
    assert line == (
        "ingest_run processed_delta=1 failed_delta=2 chunks_delta=2 page_failures_delta=1 documents_written_delta=2 pages_written_delta=3 embeddings_written_delta=3 total_processed=1 total_failed=2 total_chunks=2 "
        f'current_status=failed current_item="file:{tmp_path}/in/partial.pdf" failed_pages="partial.pdf:1[2]" db_path="file://{tmp_path}/store"'
    )
    assert status.startswith("ingest_progress processed=1 failed=2 chunks=2 generated_at=2")
    assert read_state(str(tmp_path / "state.json"))["current_item"]["status"] == "failed"


def test_recognise_joins_lines(spark):
    pages = spark.createDataFrame([("p", bytearray(b"img"), ["en"])], "page_id string, image binary, languages array<string>")
    got = pdf.recognise(pages, lambda image, o, d, languages: (["a", "b"], [0.5, 1.0]) if o == 0 else ([], []), [(0, 180), (90, 180)]).collect()
    assert {(r.orientation, r.text, r.confidence) for r in got} == {(0, "a\nb", 0.75), (90, "", 0.0)}


def test_stream(spark, tmp_path):
    config = Config(inbox(tmp_path / "in"), f"file://{tmp_path}/seen", f"file://{tmp_path}/store", recognition=False)
    query = start(spark, config, f"file://{tmp_path}/checkpoint", files_per_batch=2)
    assert query.awaitTermination(120)
    assert Store(spark, config.store).read("documents").count() == 2


def test_manifest_and_seen(spark, tmp_path):
    assert files.load_manifest(spark, None).count() == 0
    assert files.load_seen(spark, f"file://{tmp_path}/none").count() == 0
    entry = [("a.pdf", "u", "L", None)]
    files.write_manifest(spark.createDataFrame(entry, "file_name string, source_url string, source_label string, document_title string"), f"file://{tmp_path}/manifest")
    assert [tuple(r) for r in files.load_manifest(spark, f"file://{tmp_path}/manifest").collect()] == entry
    (tmp_path / "s").write_text("x\n\ny\nx\n")
    assert sorted(r.sha256 for r in files.load_seen(spark, f"file://{tmp_path}/s").collect()) == ["x", "y"]


def test_state_and_flags(tmp_path):
    path = str(tmp_path / "deep" / "state.json")
    assert read_state(path)["processed_count"] == 0
    write_state({"processed_count": 3}, path)
    assert read_state(path)["processed_count"] == 3
    c = cli.config_of(cli.parser().parse_args(["--inbox", "x", "--languages", "de,,fr ", "--ocr-fallback", "off"]))
    assert (c.languages, c.recognition, c.max_documents) == (("de", "fr"), False, 25)
    assert cli.main(["--inbox", "x", "--max-docs", "0"]) == cli.BAD_ARGUMENTS and cli.main(["--help"]) == cli.OK
