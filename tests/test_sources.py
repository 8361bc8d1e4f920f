import json
import os

import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from conftest import SAMPLE
from quarry.operators.borders import ChunkParams
from quarry.operators.enrich import Encoder, text_keys
from quarry.operators.index import VectorTable
from quarry.plans import ingest
from quarry.schemas import ELEMENT_JSON
from quarry.sources import files, folders, parsers, whole_files


def parsed(spark, content, parse):
    table = spark.createDataFrame([("d", content)], "document string, content string")
    rows = parsers.explode_elements(table.select("document", parse(F.col("content")).alias("elements"))).orderBy("pos")
    return [(r.type, r.text, r.metadata.asDict()) for r in rows.collect()]


def test_text(spark):
    content = "# Head line\r\n\n  - item one\nShort heading\nA sentence ends here.\n   \n" + "long " * 40
    assert [r[:2] for r in parsed(spark, content, parsers.text_elements)] == [
        ("Title", "Head line"),
        ("ListItem", "item one"),
        ("Title", "Short heading"),
        ("NarrativeText", "A sentence ends here."),
        ("NarrativeText", ("long " * 40).strip()),
    ]


def test_html(spark):
    content = (
        "<html><head><title>no</title></head><body>loose<h1>A &amp; B</h1><script>var x = '<p>no</p>';</script>"
        "<p>one<br>two <b>th</b>ree<p>four</p>tail<ul><li>item</ul><!-- <p>no</p> -->"
        "<table><tr><td>x</td><td>y</td></tr></table>after"
        "<img alt='' src='data:image/png;base64,QUJD'><img src='http://x/y.png'></body></html>"
    )
    rows = parsed(spark, content, parsers.html_elements)
    assert [r[:2] for r in rows] == [
        ("UncategorizedText", "loose"),
        ("Title", "A & B"),
        ("NarrativeText", "one two three"),
        ("NarrativeText", "four"),
        ("UncategorizedText", "tail"),
        ("ListItem", "item"),
        ("Table", "x y"),
        ("UncategorizedText", "after"),
        ("Image", ""),
    ]
    assert rows[6][2]["text_as_html"] == "<table><tr><td>x</td><td>y</td></tr></table>"
    assert (rows[8][2]["image_base64"], rows[8][2]["filetype"]) == ("QUJD", "png")


def test_csv(spark):
    rows = parsed(spark, "a, b\r\n\r\n1,2\n", parsers.csv_elements)
    html = "<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>"
    assert [(r[0], r[1], r[2]["text_as_html"]) for r in rows] == [("Table", "a b\n1 2", html)]
    assert parsed(spark, "\n\n", parsers.csv_elements) == []


@pytest.mark.parametrize(
    "content,cells",
    [
        ('"x, y",2', [["x, y", "2"]]),
        ('"say ""no""",""\n"two\nlines",z\n', [['say "no"', ""], ["two\nlines", "z"]]),
        ('5" pipe,"open\n1,2', [['5" pipe', '"open'], ["1", "2"]]),
        ("a,,b,\r\n,,", [["a", "", "b", ""], ["", "", ""]]),
        ("last", [["last"]]),
        ('"' + 'long ""quoted"" cell ' * 20_000 + '",1', [[('long "quoted" cell ' * 20_000).strip(), "1"]]),
    ],
)
def test_csv_cells(spark, content, cells):
    html = parsed(spark, content, parsers.csv_elements)[0][2]["text_as_html"]
    rows = html.removeprefix("<table>").removesuffix("</table>").split("</tr>")[:-1]
    assert [r.removeprefix("<tr><td>").removesuffix("</td>").split("</td><td>") for r in rows] == cells


@pytest.mark.parametrize(
    "name,strategy",
    [
        ("document.pdf", "hi_res"),
        ("presentation.PPTX", "hi_res"),
        ("document.docx", "hi_res"),
        ("readme.txt", "fast"),
        ("page.html", "auto"),
        ("file.xyz", "auto"),
        ("noextension", "auto"),
    ],
)
def test_route(spark, name, strategy):
    row = files.route(spark.createDataFrame([(f"/data/src/{name}",)], "path string")).first()
    assert row.strategy == strategy and row.languages == ["eng"]
    assert (row.extract_image_block_types is not None) == name.lower().endswith((".pdf", ".pptx"))
    assert row.hi_res_model_name == ("yolox" if name == "document.pdf" else None)


def test_json_name_changes_the_last_suffix_only(spark):
    names = spark.createDataFrame([("/a/src/x.pdf.pdf",), ("/a/src/.hidden",), ("b",)], "p string")
    assert [r[0] for r in names.select(files.json_name(F.col("p"))).collect()] == ["x.pdf.json", ".hidden.json", "b.json"]


def test_folder_of_files(spark, tmp_path):
    (tmp_path / "a.TXT").write_text("Été line.\n")
    (tmp_path / "d.md").write_bytes(b"# bad \xff byte")
    (tmp_path / "b.html").write_text("<p>para</p>")
    (tmp_path / "c.pdf").write_bytes(b"%PDF\xff\xfe\x00\x80")
    for name in ("e.csv", "f.bin"):
        (tmp_path / name).write_bytes(b"")
    extracted = files.extract(files.read_files(spark, str(tmp_path)))
    log = {r.filename: r for r in files.extract_log(extracted).collect()}
    assert (log["a.TXT"].status, log["a.TXT"].elements_count, log["a.TXT"].strategy) == ("success", 1, "fast")
    assert (log["c.pdf"].status, log["c.pdf"].error) == ("failed", "no reader for file type .pdf")
    # What cannot be decoded is a row of the log, like a type without a reader; empty files have no elements.
    assert (log["d.md"].status, log["d.md"].error, log["d.md"].elements_count) == ("failed", "content is not UTF-8", None)
    assert (log["e.csv"].status, log["e.csv"].elements_count) == ("success", 0)
    assert log["f.bin"].error == "no reader for file type .bin"
    assert files.extract_summary(files.extract_log(extracted)).first().asDict() == {
        "total": 6, "successful": 3, "failed": 3, "elements": 2
    }
    elements = parsers.explode_elements(extracted)
    assert {(r.document, r.text) for r in elements.collect()} == {("a.TXT", "Été line."), ("b.html", "para")}
    # Only files of known types are read, and only up to a size.
    read = files.read_files(spark, str(tmp_path), max_bytes=9)
    assert {r.filename for r in read.filter("content is not null").collect()} == {"e.csv"}
    assert {r.problem for r in read.filter("length > 9 and extension <> '.pdf'").collect()} == {"file of more than 9 bytes"}
    listing = files.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in listing


def test_summary_of_a_log(spark):
    rows = [("doc1.pdf", "success", 10, "HI_RES", None), ("doc2.pdf", "success", 5, "FAST", None), ("doc3.pdf", "failed", None, None, "API Error")]
    log = spark.createDataFrame(rows, "filename string, status string, elements_count int, strategy string, error string")
    summary = files.extract_summary(log).first()
    assert (summary.total, summary.successful, summary.failed) == (3, 2, 1)


def test_element_files(spark, tmp_path):
    rows = [{"type": t, "text": x, "metadata": {"page_number": m[0], "unknown": [1]}} for t, x, m in SAMPLE]
    (tmp_path / "good.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "nulls.json").write_text('[{"type": null, "text": null}]')
    (tmp_path / "bad.json").write_text(json.dumps(rows)[:-5])
    (tmp_path / "empty.json").write_text("[]")
    elements = files.read_elements_json(spark, str(tmp_path))
    good = elements.filter("document = 'good'").orderBy("pos").collect()
    assert [(r.type, r.text, r.metadata.page_number) for r in good] == [(t, x, m[0]) for t, x, m in SAMPLE]
    assert [(r.type, r.text) for r in elements.filter("document = 'nulls'").collect()] == [("", "")]
    log = files.json_elements_log(files.parse_elements(files.read_json_texts(spark, str(tmp_path))))
    assert {(r.filename, r.status, r.elements_count) for r in log.collect()} == {
        ("good.json", "success", 5), ("nulls.json", "success", 1), ("empty.json", "success", 0), ("bad.json", "failed", None)
    }


def test_chunk_files(spark, sample, tmp_path, tmp_path_factory):
    records = ingest.chunk_documents(sample, ChunkParams("basic", 10, 100))
    lines = [r[0] for r in records.select(files.chunk_json(records)).collect()]
    for name in ("one_chunks.json", "two_chunks.json", "other.json"):
        (tmp_path / name).write_text("[" + ",".join(lines) + "]")
    folder = files.read_chunks_json(spark, str(tmp_path))
    assert folder.count() == 2 * len(lines)
    table = VectorTable(spark, str(tmp_path_factory.mktemp("store") / "index"), dimensions=8)
    encoder, n = Encoder(dimensions=8), len(lines)
    told = ingest.index_from_json(table, spark, str(tmp_path / "one_chunks.json"), encoder)
    assert told == {"upserted": n, "total_vectors": n, "dimensions": 8}
    # The second file has the same chunks: rows are sent again, and vectors on file are taken.
    cache = text_keys(records, "contextualized_content").select(
        "text_sha", F.array_repeat(F.lit(2.0).cast("float"), 8).alias("embedding")
    )
    told = ingest.index_from_json(table, spark, str(tmp_path), encoder, cache)
    assert told == {"upserted": 2 * n, "total_vectors": n, "dimensions": 8}
    assert {tuple(r.embedding) for r in table.read().collect()} == {(2.0,) * 8}
    single = files.read_chunks_json(spark, str(tmp_path / "one_chunks.json")).drop("filename", "file_pos")
    assert sorted(map(str, single.collect())) == sorted(map(str, records.select(*single.columns).collect()))


def test_written_elements_read_back(spark, sample, tmp_path):
    files.write_elements(sample, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).exceptAll(sample).count() == 0
    files.write_json(sample.select("document", "pos", "type", "text"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == sample.count()


def test_files_of_arrays(spark, sample, tmp_path):
    two = sample.unionByName(sample.withColumn("document", F.lit("other.pdf")))
    files.write_element_files(two.withColumn("document", F.when(F.col("document") == "doc", "a b.html").otherwise(F.col("document"))), str(tmp_path / "e"))
    names = {p.name for p in (tmp_path / "e").iterdir()}
    assert {"a b.json", "other.json", "_SUCCESS"} == {n for n in names if not n.endswith(".crc")}
    assert [e["text"] for e in json.loads((tmp_path / "e" / "other.json").read_text())] == [x for _, x, _ in SAMPLE]
    back = files.read_elements_json(spark, str(tmp_path / "e"))
    assert back.filter("document = 'other'").drop("document").exceptAll(sample.drop("document")).count() == 0
    chunks = ingest.chunk_documents(two, ChunkParams("basic", 10, 100))
    files.write_chunk_files(chunks, str(tmp_path / "c"))
    read = files.read_chunks_json(spark, str(tmp_path / "c"))
    assert {r.filename for r in read.collect()} == {"doc_chunks.json", "other_chunks.json"}
    assert [r.file_pos for r in read.filter("document = 'doc'").orderBy("file_pos").collect()] == list(range(chunks.filter("document = 'doc'").count()))
    assert read.drop("filename", "file_pos").exceptAll(chunks.select(*[c for c in read.columns if c not in ("filename", "file_pos")])).count() == 0


def test_a_failed_write_leaves_no_success(spark, tmp_path):
    good = spark.createDataFrame([("a", "x"), ("b", "y")], "file string, content string")
    whole_files.write_files(good, str(tmp_path / "g"))
    assert (tmp_path / "g" / "a").read_text() == "x" and (tmp_path / "g" / "_SUCCESS").exists()
    # The same files again replace the old ones; empty contents are files too.
    whole_files.write_files(good.withColumn("content", F.lit("")), str(tmp_path / "g"))
    assert (tmp_path / "g" / "a").read_text() == ""
    bad = good.unionByName(spark.createDataFrame([("../c", "z")], "file string, content string"))
    with pytest.raises(Exception, match="not a file name"):
        whole_files.write_files(bad, str(tmp_path / "h"))
    assert not (tmp_path / "h" / "_SUCCESS").exists() and not (tmp_path / "h" / "_temporary").exists()


def test_json_files_are_read_without_a_reader_for_each(spark, tmp_path):
    texts = {"a.json": '[{"type": "Title",\n"text": "é"}]', "b.json": "[]", "d.json": " \r\n", "e.txt": "[]", "f.json": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    read = files.read_json_texts(spark, str(tmp_path))
    assert {(r.filename, r.content) for r in read.collect()} == {(n, t) for n, t in texts.items() if n.endswith(".json") and t}
    assert "binaryfile" in read._jdf.queryExecution().executedPlan().toString().lower()


def test_a_folder_is_listed_in_one_scan(spark, tmp_path):
    for name in ("a.txt", "b c%20.md", "d.pdf", "e.txt"):
        (tmp_path / name).write_text("" if name == "e.txt" else "text")
    listed = files.list_files(spark, str(tmp_path))
    assert {(r.filename, r.extension, r.length) for r in listed.collect()} == {
        ("a.txt", ".txt", 4), ("b c%20.md", ".md", 4), ("d.pdf", ".pdf", 4), ("e.txt", ".txt", 0),
    }
    assert listed._jdf.queryExecution().optimizedPlan().toString().count("binaryFile") == 1


ODD_NAMES = ("a b.json", "c%20d.json", "é.TXT", "_k=v.md", "_hidden.md", ".h.md", "_metadata.md", "x._COPYING_", "new\nline.md", "[z].csv", "plus+#?.json", "none")


def test_many_files_are_not_held_by_the_driver(spark, tmp_path, monkeypatch):
    n = folders.MANY_FILES + 1
    for i in range(n):
        content = (b"", b"A sentence ends here.", b"bad \xff", b"long " * 20)[i % 4]
        (tmp_path / f"doc_{i}{('.txt', '.MD', '.pdf')[i % 3]}").write_bytes(content)
    for name in ODD_NAMES:
        (tmp_path / name).write_text("text")
    with open(os.fsencode(tmp_path) + b"/odd\xff.txt", "wb") as odd:
        odd.write(b"x")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "a.txt").write_text("x")
    (tmp_path / "link.md").symlink_to(tmp_path / "é.TXT")
    (tmp_path / "broken.md").symlink_to(tmp_path / "nothing")

    def made():
        read = files.read_files(spark, f"{tmp_path}/", max_bytes=50)
        return files.list_files(spark, f"{tmp_path}/"), read, files.extract_log(files.extract(read))

    many = made()
    for table in many:
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert table.inputFiles() == [] and "LocalRelation" not in plan and "binaryFile" not in plan
    monkeypatch.setattr(folders, "MANY_FILES", 10**6)
    for here, there in zip(many, made(), strict=True):
        assert sorted(map(repr, here.collect())) == sorted(map(repr, there.collect()))
    # Three of the odd names are hidden; the good link counts.
    assert many[0].count() == n + len(ODD_NAMES) - 3 + 1


def test_files_of_a_task_are_read_in_bounded_batches(tmp_path):
    for i, n in enumerate((5, 5, 30, 0, 1, 9)):
        (tmp_path / str(i)).write_bytes(b"x" * n)
    rows = {"filename": list("012345"), "length": [5, 5, 30, 0, 1, 9], "wanted": [True, True, True, False, True, True]}
    parts = [*folders.with_contents(fs.LocalFileSystem(), str(tmp_path), pa.RecordBatch.from_pydict(rows), most=10)]
    assert [p["filename"].to_pylist() for p in parts] == [["0", "1"], ["2", "3"], ["4", "5"]]
    assert [c for p in parts for c in p["content"].to_pylist()] == [b"x" * 5, b"x" * 5, b"x" * 30, None, b"x", b"x" * 9]


def test_a_folder_is_listed_alike_in_other_stores(spark, tmp_path, monkeypatch):
    for name in ODD_NAMES:
        (tmp_path / name).write_text("text")
    (tmp_path / "below").mkdir()
    here = sorted(folders.entries(fs.LocalFileSystem(), str(tmp_path)))
    assert here == sorted(folders.entries(fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()), ""))
    monkeypatch.setattr(folders, "MANY_FILES", 3)
    place = folders.Folder(spark, str(tmp_path))
    assert place.has_many() and not folders.Folder(spark, f"{tmp_path}/*").has_many()
    assert not any(folders.Folder(spark, str(tmp_path / name)).has_many() for name in ("none", "below", "nothing"))
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(folders, "opened", lambda uri: (store, ""))
    assert place.has_many() and not folders.Folder(spark, str(tmp_path / "nothing")).has_many()

    def unknown(uri):
        raise pa.ArrowInvalid("Unrecognized filesystem type in URI")

    # What only Spark reads stays with Spark.
    monkeypatch.setattr(folders, "opened", unknown)
    assert not place.has_many()


def test_many_json_files_are_not_held_by_the_driver(spark, tmp_path, monkeypatch):
    records = [(f"doc {i}.pdf" if i % 5 else f"é_{i}", 0, f"text {i}") for i in range(folders.MANY_FILES + 1)]
    rows = spark.createDataFrame(records, "document string, pos int, text string")
    elements = rows.select("document", "pos", F.lit("Title").alias("type"), "text", F.lit(None).cast(ELEMENT_JSON["metadata"].dataType).alias("metadata"))
    files.write_element_files(elements, str(tmp_path))
    files.write_chunk_files(ingest.chunk_documents(elements, ChunkParams("basic", 10, 100)), str(tmp_path))
    for name in ODD_NAMES:
        (tmp_path / name).write_text("[]")
    signs = "".join(chr(c) for c in [*range(32, 127), 0xA0, 0x2003, 0x3000, 0x1F600, 0x85, 0x200B] if chr(c) not in "/:")
    (tmp_path / f"x{signs}.json").write_text("[]")
    (tmp_path / "empty.json").write_text("")

    def made():
        folder = str(tmp_path)
        texts = [files.read_json_texts(spark, folder, p) for p in ("*.json", "*", "{[a-d],doc?1}*[!s].json", "*\\%20*")]
        return [*texts, files.read_chunks_json(spark, folder), files.read_elements_json(spark, folder)]

    many = made()
    assert all(table.inputFiles() == [] for table in many)
    monkeypatch.setattr(folders, "MANY_FILES", 10**6)
    for here, there in zip(many, made(), strict=True):
        assert here.dtypes == there.dtypes
        assert sorted(map(repr, here.collect())) == sorted(map(repr, there.collect()))
    assert many[4].select("document").distinct().count() == many[5].filter("type = 'Title'").count() == len(records)
