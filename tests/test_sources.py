import io
import zipfile

import pytest
from pyspark.sql import functions as F

from furrow.operators import pages as pg
from furrow.plans import onboard
from furrow.sources import ocr, readers

PAD = " The field should be looked at again before the end of the week by whoever works on it."


def docx(paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="w"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("docs")
    (root / "alphaland.txt").write_text(f"Alphaland.\r\n• Lentil stands well.{PAD}\fSecond page\n", encoding="utf-8")
    (root / "alphaland.html").write_text(f"<html><head><title>x</title></head><body><p>Barley &amp; tomato in Alphaland.{PAD}</p><script>no()</script></body></html>")
    (root / "alphaland.docx").write_bytes(docx(["Alphaland note", "Goat sheds need &amp; deserve care." + PAD, "Deworming is due."]))
    (root / "old.doc").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1")
    return str(root)


def test_formats_read_and_the_unreadable_is_refused(spark, folder, lexicon, settings):
    docs = readers.read_documents(spark, folder).persist()
    pages = {(r["document"], r["page"]): r["text"] for r in readers.pages_of(docs).collect()}
    assert pages[("alphaland.txt", 1)].startswith("Alphaland.\nLentil stands well.") and pages[("alphaland.txt", 2)] == "Second page"
    assert pages[("alphaland.html", 1)].startswith("Barley & tomato") and "no()" not in pages[("alphaland.html", 1)]
    assert pages[("alphaland.docx", 1)].split("\n")[1].startswith("Goat sheds need & deserve")
    refused = readers.refusals_of(docs).collect()
    assert [r["document"] for r in refused] == ["old.doc"] and "could not be opened" in refused[0]["reason"]
    got = onboard.extract(readers.pages_of(docs), lexicon, settings, refusals=readers.refusals_of(docs))
    outcome = {r["document"]: r["status"] for r in got.decisions.collect()}
    assert outcome == {"alphaland.txt": "ok", "alphaland.html": "ok", "alphaland.docx": "ok", "old.doc": "refused"}


def test_a_missing_path_is_an_error(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_documents(spark, "/no/such/folder").count()


def test_pattern_and_paths(spark, folder):
    assert readers.read_documents(spark, folder, "*.txt").count() == 1
    assert readers.resolve_paths(["nope.pdf"], "/data", []) == ["/data/nope.pdf"]
    assert readers.resolve_paths([folder], "/data", []) == [folder]
    assert readers.text_pages(spark, f"{folder}/alphaland.txt").count() == 2


def test_first_reader_that_opens_wins():
    def broken(name, content):
        raise RuntimeError("no")

    label, pages, reason = readers.open_document("a.txt", b"hello", (("x", broken), ("y", lambda n, c: [("t", False)])))
    assert (label, pages, reason) == ("y", [("t", False)], None)
    assert readers.open_document("a.txt", b"", (("x", broken),))[2] == "could not be opened (x: no)"


ADVICE = "Spray the lentil twice and irrigate the tomato in Riverbend before noon." + PAD
GRID = "Rainfall grid 12 44 81 07 lentil " + "9 8 7 6 " * 40


def fake_engine():
    texts = {2: ADVICE, 3: GRID, 5: "x"}

    def engine(content, page, settings):
        if page == 4:
            raise OSError("cannot render")
        return texts[page]

    return engine


engine = fake_engine()


@pytest.fixture(scope="module")
def recovered(spark, lexicon, settings):
    rows = [("alphaland.pdf", 1, "Alphaland. Lentil." + PAD, False, False), ("alphaland.pdf", 2, "Riverbend heading, see picture below, forty", False, True),
            ("alphaland.pdf", 3, "Some heading text that is long enough here", False, True), ("alphaland.pdf", 4, "Another heading text that is long enough", False, True),
            ("alphaland.pdf", 5, "And a last heading text that is long enough", False, True), ("alphaland.txt", 1, "Alphaland." + PAD, False, True)]
    pages = spark.createDataFrame(rows, "document string, page int, text string, ocr boolean, has_image boolean")
    files = spark.createDataFrame([("alphaland.pdf", bytearray(b"%PDF")), ("alphaland.txt", bytearray(b"x"))], "document string, content binary")
    return pages, files


def test_recovered_text_is_kept_only_where_it_helps(spark, recovered, lexicon, settings):
    scored = {(r["document"], r["page"]): r for r in ocr.augment(*recovered, engine, lexicon, settings).collect()}
    good = scored[("alphaland.pdf", 2)]
    assert good["ocr_accepted"] and good["ocr"] and good["text"].startswith("Riverbend heading") and ADVICE in good["text"]
    assert not scored[("alphaland.pdf", 3)]["ocr_accepted"]  # a grid names no topics
    assert scored[("alphaland.pdf", 4)]["error"].startswith("OSError")
    assert not scored[("alphaland.txt", 1)]["ocr_attempted"]  # only PDF pages are attempted
    report = {r["document"]: r for r in pg.recovery_report(ocr.augment(*recovered, engine, lexicon, settings)).collect()}["alphaland.pdf"]
    assert (report["pages_attempted"], report["pages_accepted"], report["pages_errored"]) == (4, 1, 1)
    assert report["first_error"].startswith("OSError") and report["terms_after"] > report["terms_before"]


def test_recovery_reaches_the_passages(recovered, lexicon, settings):
    pages, files = recovered
    got = onboard.extract(pages, lexicon, settings, files=files, engine=engine)
    flags = {(r["document"], r["page"]): r["from_ocr"] for r in got.passages.collect()}
    assert flags[("alphaland.pdf", 2)] and not flags[("alphaland.pdf", 1)] and got.ocr.count() == 2
    plain = onboard.extract(pages, lexicon, settings)
    assert plain.ocr is None and plain.passages.where("from_ocr").count() == 0


def test_missing_engine_says_what_to_run():
    ready, why = ocr.ocr_available()
    assert not ready and "pytesseract" in why


def test_gates(spark, make_pages, settings):
    pages = make_pages({"half": ["x" * 40, "x"], "less": ["x" * 40, "x", "x"], "pad": [" " * 60], "thin": ["y" * 100, "z" * 400]})
    gate = {r["document"]: r["readable"] for r in pg.scan_gate(pages, settings).collect()}
    assert gate == {"half": True, "less": False, "pad": False, "thin": True}
    thin = {r["document"]: r["thin_warning"] for r in pg.thin_report(pages, settings).collect()}
    assert thin == {"half": True, "less": True, "pad": True, "thin": True}


def _zip(path, files):
    with zipfile.ZipFile(path, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)


def test_tabs_part_words_and_books_follow_their_spine(tmp_path):
    _zip(tmp_path / "a.docx", {"word/document.xml": "<w:p><w:t>Tomato</w:t><w:tab/><w:t>Fruiting</w:t></w:p>"})
    assert readers.read_markup("a.docx", (tmp_path / "a.docx").read_bytes())[0][0].split() == ["Tomato", "Fruiting"]
    pages = {f"OPS/c{n}.xhtml": f"<p>chapter {n}</p>" for n in (1, 2, 10)}
    _zip(tmp_path / "b.epub", pages)
    plain = [t.strip() for t, _ in readers.read_markup("b.epub", (tmp_path / "b.epub").read_bytes())]
    assert plain == ["chapter 1", "chapter 2", "chapter 10"]
    spine = {
        "META-INF/container.xml": '<c xmlns="urn:x"><rootfiles><rootfile full-path="OPS/book.opf"/></rootfiles></c>',
        "OPS/book.opf": '<package xmlns="urn:y"><manifest>' + "".join(f'<item id="i{n}" href="c{n}.xhtml"/>' for n in (1, 2, 10))
        + '</manifest><spine><itemref idref="i10"/><itemref idref="i1"/></spine></package>'}
    _zip(tmp_path / "c.epub", {**pages, **spine})
    ordered = [t.strip() for t, _ in readers.read_markup("c.epub", (tmp_path / "c.epub").read_bytes())]
    assert ordered == ["chapter 10", "chapter 1"]


def test_equal_names_in_two_folders_are_two_documents(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text("text of " + folder)
    both = [str(tmp_path / "a" / "x.txt"), str(tmp_path / "b" / "x.txt")]
    names = lambda *a, **k: sorted(r["document"] for r in readers.read_documents(spark, *a, **k).collect())
    assert names(both) == ["a/x.txt", "b/x.txt"] == names(both, root=str(tmp_path))
    assert names(str(tmp_path / "a")) == ["x.txt"] and names(both[0]) == ["x.txt"]
    assert names(both[0], root=str(tmp_path / "b")) == [both[0]]
