import io
import json
import zipfile

from pyspark.sql import functions as F

from quillspark import providers
from quillspark.plans.catalog import COLLECTIONS, Catalog, schema_of, schema_of_yaml
from quillspark.plans.ledger import Ledger
from quillspark.plans.pipeline import Settings, run
from quillspark.sources import readers, sinks
from quillspark.streaming import ingest

import pytest


def docx(title: str, *paragraphs: str) -> bytes:
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(
            "word/document.xml",
            f'<w:document xmlns:w="{w}"><w:body>' + "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs) + "</w:body></w:document>",
        )
        z.writestr(
            "docProps/core.xml", f'<c xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{title}</dc:title><dc:creator>A. Writer</dc:creator></c>',
        )
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    f = tmp_path / "in"
    (f / "a.txt").write_text("THE DAY\nfirst line\n\nsecond", encoding="utf-8")
    (f / "b.json").write_text('{"x": 1}', encoding="utf-8")
    (f / "bad.json").write_text("{", encoding="utf-8")
    (f / "c.docx").write_bytes(docx("Plan", "One", "Two"))
    (f / "broken.docx").write_bytes(b"no zip")
    (f / "d.pdf").write_bytes(b"%PDF")
    (f / "e.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + (640).to_bytes(4) + (480).to_bytes(4))
    (f / "skip.xyz").write_text("?")
    return f


def test_load(spark, folder):
    got = {r.metadata.filename: r for r in readers.load(spark, str(folder)).collect()}
    assert sorted(got) == ["a.txt", "b.json", "bad.json", "broken.docx", "c.docx", "d.pdf", "e.png"]
    assert got["c.docx"].content == "One\nTwo" and got["c.docx"].metadata.title == "Plan"
    assert got["broken.docx"].error and got["bad.json"].error and got["d.pdf"].error == "no extractor for pdf"
    assert got["e.png"].content == "width=640 height=480" and got["a.txt"].error is None
    with_pdf = readers.load(
        spark, str(folder), providers={"pdf": lambda data, path: {"content": "text of it", "pages": [{"page_number": 1, "text": "text of it"}]}},
    )
    assert {r.metadata.filename: r.metadata.num_pages for r in with_pdf.where("content = 'text of it'").collect()} == {"d.pdf": 1}


def test_discovery_and_sizes(spark, folder):
    assert readers.size_of("1.5K") == 1536 and readers.size_of("2MB") == 2 << 20
    assert {r.route for r in readers.discover(spark, str(folder)).collect()} == {"text", "json", "docx", "pdf", "image"}
    assert readers.large_files(spark, str(folder), "5", 3).count() == 3
    assert readers.file_hashes(spark, str(folder)).where("length(sha256) = 64").count() == 8


def test_pipelines(spark, folder):
    docs = readers.load(spark, str(folder)).where("error is null")
    md = run(docs, Settings(kind="markdown")).where("metadata.filename = 'a.txt'").first().markdown
    assert md.startswith("# A\n\n## Contents\n\n  - [THE DAY](#the-day)") and "## THE DAY\nfirst line" in md
    j = json.loads(run(docs, Settings(kind="structured")).where("metadata.filename = 'a.txt'").first().json)
    assert j["sections"][0]["heading"] == "THE DAY"
    store = run(docs, Settings(kind="store", chunk_size=2, chunk_overlap=1))
    assert store.columns == ["id", "text", "chunk_index", "document_id"] and store.count() == store.select("id").distinct().count()
    with pytest.raises(ValueError):
        Settings(kind="odd")
    with pytest.raises(ValueError):
        Settings(strategy="exclusive", processors=("a", "b"))


def test_pipeline_applies_its_chain(spark):
    rows = [("a", "good text", None), ("b", None, "broken"), ("c", " \n ", None), ("d", "x", None), ("b", None, "broken"), ("e", None, "broken")]
    d = spark.createDataFrame([(i, f"/in/{i}.pdf", c, e) for i, c, e in rows], "id string, source_path string, content string, error string")
    ocr = lambda x: x.withColumn("content", F.when(F.col("id") != "e", F.concat(F.lit("read "), "id"))).withColumn(
        "error", F.when(F.col("id") == "e", "unreadable"),
    )
    got = run(d, Settings(processors=("text", "ocr"), least_chars=3), {"ocr": ocr})
    assert got.columns == d.columns and sorted((r.id, r.content, r.error) for r in got.collect() if r.content) == [
        ("a", "good text", None), ("b", "read b", None), ("b", "read b", None), ("c", "read c", None), ("d", "read d", None),
    ]
    assert [(r.content, r.error) for r in got.where("id = 'e'").collect()] == [(None, "unreadable")]
    assert {r.id: r.error for r in run(d, Settings()).collect()} == {"a": None, "b": "broken", "c": "too little text", "d": None, "e": "broken"}
    with pytest.raises(ValueError):
        run(d, Settings(processors=("text", "gone")))


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, "x", ["a", "b"])], "id int, content string, tags array<string>")
    sinks.write_formats(d, str(tmp_path / "out"), ("text", "json"))
    assert spark.read.text(str(tmp_path / "out/text")).first().value == "x"
    sinks.write_csv_split(d, str(tmp_path / "csv"), "id")
    assert readers.csv_strings(spark, str(tmp_path / "csv/tags")).count() == 2
    assert {r.column: r.width for r in sinks.column_widths(d.select("id", "content")).collect()} == {"id": 4, "content": 9}
    assert set(sinks.merged(("a", d.select("id")), ("b", d.select("content"))).columns) == {"id", "content", "source"}


def test_workbook(spark, tmp_path):
    d = spark.createDataFrame([(1, "a<b"), (2, None)], "id int, v string")
    sinks.write_workbook(str(tmp_path / "b.xlsx"), {"All: of it": d, "Rest": d.limit(0)})
    with zipfile.ZipFile(tmp_path / "b.xlsx") as z:
        assert 'name="All_ of it"' in z.read("xl/workbook.xml").decode()
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert "a&lt;b" in sheet and sheet.count("<row>") == 3 and 'width="5"' in sheet


def test_catalog(spark):
    c = Catalog(spark, "docs_test")
    assert sorted(c.ensure()) == sorted(COLLECTIONS) and c.ensure() == []
    rows = spark.createDataFrame([("d1", 0, "hello"), ("d1", 1, "again"), (None, 2, "no key")], "filename string, chunk_index int, text string")
    assert c.ingest("KnowledgeMain", rows, ["filename", "chunk_index"]) == 1
    c.ingest("KnowledgeMain", rows, ["filename", "chunk_index"])
    assert c.table("KnowledgeMain").count() == 2
    with pytest.raises(ValueError):
        c.ingest("KnowledgeMain", rows, ["filename"], max_errors=0)
    c.delete("KnowledgeMain", "chunk_index = 1")
    assert c.table("KnowledgeMain").first().text == "hello"
    with pytest.raises(ValueError):
        c.drop(["KnowledgeMain"])
    c.drop(list(COLLECTIONS), yes_i_know=True)
    assert c.list() == []


def test_schemas():
    name, s = schema_of_yaml(
        "name: Notes\nproperties:\n  - {name: text, data_type: text}\n  - {name: n, data_type: int}\n  - {name: tags, data_type: 'text[]'}\n  - {name: odd, data_type: unheard}\n"
    )
    assert name == "Notes" and [f.dataType.simpleString() for f in s.fields] == [
        "string", "string", "bigint", "array<string>", "string", "array<float>",
    ]
    assert schema_of("a TEXT").names == ["uuid", "a"]


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    todo = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "key string, n int")
    assert ledger.remaining(todo, "key").count() == 3
    ledger.add(todo.where("key = 'a'"), "key", pages="n")
    ledger.add(todo.where("key = 'b'"), "key", "failed")
    assert {r.key for r in ledger.remaining(todo, "key").collect()} == {"b", "c"}
    assert {r.key: r.next_page for r in ledger.next_page(todo, "key", "n").collect()} == {"a": None, "b": 1, "c": 1}
    ledger.clear()
    assert ledger.read().count() == 0


def test_providers(spark):
    d = spark.createDataFrame([(1, "Say:\n\nA title\nbody"), (2, None)], "id int, p string")
    assert json.loads(providers.completed(d, "p", providers.rule_completer).orderBy("id").first().answer) == {"title": "A title"}

    def fails(prompts):
        raise RuntimeError("down")

    assert {r.answer_error for r in providers.completed(d, "p", fails).collect()} == {"down"}
    good = lambda x: x.select("id", F.col("p").alias("content"), F.when(F.col("p").isNull(), "empty").alias("error"))
    bad = lambda x: x.select("id", F.lit(None).cast("string").alias("content"), F.lit("never").alias("error"))
    got = {r.id: (r.processor, r.error) for r in providers.first_success(d, "id", [("bad", bad), ("good", good)]).collect()}
    assert got == {1: ("good", None), 2: ("good", "empty")}


def test_streams(spark, folder, tmp_path):
    q = ingest.write(ingest.chunk_stream(ingest.text_stream(spark, str(folder / "*.txt")), 2, 0), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    again = ingest.write(ingest.chunk_stream(ingest.text_stream(spark, str(folder / "*.txt")), 2, 0), str(tmp_path / "out"), str(tmp_path / "cp"))
    again.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_stream_of_events(spark, data, tmp_path):
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    e = spark.readStream.schema(schema).parquet(f"{data}/events.parquet*")
    q = ingest.first_seen_stream(e, "event_id", "ts").writeStream.format("memory").queryName("first_seen").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("first_seen").count() == spark.read.parquet(f"{data}/events.parquet").select("event_id").distinct().count()


def test_command_line(spark, folder, tmp_path, capsys):
    from quillspark import cli

    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    assert cli.main(["run", str(folder), out, "--kind", "markdown", "--formats", "markdown,json", "--ledger", ledger]) == 0
    assert spark.read.json(f"{out}/json").where("error is null").count() == 4
    done = {r.key.rsplit("/", 1)[-1]: r.status for r in Ledger(spark, ledger).read().collect()}
    assert done["a.txt"] == "processed" and done["d.pdf"] == "failed"
    (tmp_path / "notes.yaml").write_text("name: Notes\nproperties:\n  - {name: text, data_type: text}\n")
    (tmp_path / "rows.jsonl").write_text('{"text": "one"}\n{"text": "two"}\n{"text": "one"}\n')
    db = ["--database", "cli_test"]
    cli.main([*db, "create", str(tmp_path / "notes.yaml")])
    cli.main([*db, "ingest", "Notes", str(tmp_path / "rows.jsonl"), "--key", "text"])
    assert spark.table("cli_test.Notes").count() == 2
    capsys.readouterr()
    cli.main([*db, "list"])
    assert capsys.readouterr().out.strip().lower() == "notes"
    with pytest.raises(ValueError):
        cli.main([*db, "drop", "Notes"])
    cli.main([*db, "drop", "Notes", "--yes-i-know"])


def test_layered_settings(tmp_path):
    from quillspark.plans import pipeline

    (tmp_path / "c.yaml").write_text("chunk_size: 500\nkind: chunk\nprocessors: [text, layout]\nother: 1\n")
    (tmp_path / ".env").write_text("# note\nPIPELINE_CHUNK_SIZE=300\nPIPELINE_CHUNK_OVERLAP='20'\nPIPELINE_KIND=text\n")
    got = pipeline.layered({"PIPELINE_KIND": "markdown"}, str(tmp_path / "c.yaml"), str(tmp_path / ".env"))
    assert (got.kind, got.chunk_size, got.chunk_overlap, got.processors, got.strategy) == ("markdown", 500, 20, ("text", "layout"), "fallback_chain")
    assert pipeline.layered({"PIPELINE_PROCESSORS": "a, b"}, None, None).processors == ("a", "b") and pipeline.layered({}, "none.yaml", "none").chunk_size == 800


def test_workbook_cuts_no_cell(spark, tmp_path):
    from quillspark.sources import sinks

    long = spark.createDataFrame([("x" * 40_000, [1])], "a string, b array<int>")
    with pytest.raises(ValueError, match="40000"):
        sinks.write_workbook(str(tmp_path / "w.xlsx"), {"s": long})
    sinks.write_workbook(str(tmp_path / "w.xlsx"), {"s": long.limit(0)})
