"""Discovery and extraction over files made in a fresh temporary directory."""

import os
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from doctriage.operators import extract as X
from doctriage.plans.fixtures import docx_bytes, make_docx
from doctriage.sources import discover as D


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="doctriage-files-")
    files = {
        "a/invoice.txt": "Invoice 😀\r\nAmount due\n".encode(),
        "a/bad.txt": b"ok \xff bytes",
        "a/sub/report.PDF": b"%PDF-1.4 not really",
        "b/invoice.txt": b"second file with the same stem",
        "b/memo.docx": docx_bytes("  Memo line one\nline two  "),
        "b/scan.jpg": b"\x89JPEG",
        "b/data.bin": b"\xfe\xfe",
        "b/notes.html": b"<p>hello</p>",
    }
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return root


def test_list_directory_glob_and_stems(spark, tree):
    df = D.list_directory(spark, tree, pattern="*.txt")
    rows = sorted((r.document_id, os.path.relpath(r.file_path, tree)) for r in df.collect())
    assert rows == [("bad", "a/bad.txt"), ("invoice", "a/invoice.txt"), ("invoice", "b/invoice.txt")]
    non_rec = D.list_directory(spark, os.path.join(tree, "a"), recursive=False)
    assert sorted(r.document_id for r in non_rec.collect()) == ["bad", "invoice"]


def test_listing_reads_no_content(spark, tree):
    plan = D.list_directory(spark, tree)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "MapInArrow" not in plan  # a scan of the stored listing


def test_list_store_prefix_and_suffix(spark, tree):
    df = D.list_store(spark, tree, prefix="a/", pattern="*.txt", bucket="bkt")
    got = sorted((r.source, r.key) for r in df.collect())
    assert got == [("s3://bkt/a/bad.txt", "a/bad.txt"), ("s3://bkt/a/invoice.txt", "a/invoice.txt")]


def test_route_and_decode(spark, tree):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tree)
    out = X.decode_text(files.withColumn("extractor", X.route_by_suffix("path")))
    got = {os.path.relpath(r.path.replace("file:", ""), tree): (r.extractor, r.text, r.extraction_error)
           for r in out.collect()}
    assert got["a/invoice.txt"] == ("text", "Invoice 😀\nAmount due\n", None)
    assert got["a/bad.txt"][1] is None
    assert got["a/bad.txt"][2] == "'utf-8' codec can't decode byte 0xff in position 3: invalid start byte"
    assert got["a/sub/report.PDF"][0] == "pdf"
    assert got["b/scan.jpg"][0] == "image"
    assert got["b/memo.docx"][0] == "docx"
    assert got["b/data.bin"][2].startswith("Unsupported file format: .bin")
    assert got["b/notes.html"] == ("other", "<p>hello</p>", None)


def test_docx_and_fallback(spark, tree):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option(
        "recursiveFileLookup", "true").load(tree)
    r = files.select(X.extract_docx("content").alias("x")).first().x
    assert (r.text, r.error) == ("Memo line one\nline two", None)

    def broken(b):
        raise RuntimeError("no service")

    out = X.extract_with_fallback(files, [broken, X._docx_text], names=["remote", "local"]).first()
    assert out.text == "Memo line one\nline two" and out.extractor == "local"
    assert out.extraction_errors == ["remote: RuntimeError: no service"]


def test_docx_values_become_objects_by_slices(spark, monkeypatch):
    texts = [f"line {i}\n" + "x" * (i % 7 * 20) for i in range(50)] + [None, "", " é😀 "]
    monkeypatch.setattr(X, "SLICE_BYTES", 300)
    seen = []

    def lengths(some):
        seen.append([len(t or "") for t in some])
        return [None if t is None else len(t) for t in some]
    got = X.by_slices(pa.array(texts), lengths, pa.int64())
    assert got.to_pylist() == [None if t is None else len(t) for t in texts]
    assert len(seen) > 5 and all(sum(x) <= 300 or len(x) == 1 for x in seen)  # before, a batch was objects as a whole
    assert X.by_slices(pa.array(texts).slice(40, 13), lengths, pa.int64()).to_pylist() == got.to_pylist()[40:]
    assert X.by_slices(pa.array([], pa.binary()), lengths, pa.int64()).to_pylist() == []
    df = spark.createDataFrame(list(enumerate(texts)), "n long, t string").repartition(2)
    rows = df.select("n", X.extract_docx(make_docx("t")).alias("x")).collect()
    assert {r.n: (r.x.text, r.x.error) for r in rows} == {i: ((t or "").strip(), None) for i, t in enumerate(texts)}
    bad = spark.sql("SELECT X'00' AS c UNION ALL SELECT NULL").select(X.extract_docx("c").alias("x")).collect()
    assert {(r.x.text, r.x.error) for r in bad} == {(None, "no content"), (None, "BadZipFile: File is not a zip file")}


def test_ocr_lines_and_resolve(spark):
    blocks = [("PAGE", None), ("LINE", "first"), ("LINE", None), ("WORD", "first"), ("LINE", " last ")]
    df = spark.createDataFrame([(blocks, "", None), (blocks, "given", None)],
                               "b array<struct<BlockType:string,Text:string>>, content string, ext string")
    out = df.select(X.ocr_lines("b").alias("t"), X.ocr_lines("b", trim=True).alias("tt"),
                    X.resolve_text("content", X.ocr_lines("b")).alias("r")).collect()
    assert out[0].t == "first\n\n last " and out[0].tt == "first\n\n last"
    assert out[0].r == "first\n\n last " and out[1].r == "given"


def test_file_lists(spark, tmp_path):
    txt = tmp_path / "list.txt"
    txt.write_text("s3://bucket1/doc1.pdf\n\n# comment\n  /local/path/doc3.jpg  \ns3://onlybucket\n"
                   "s3://bucket2/dir/doc2.pdf\n")
    rows = D.read_file_list(spark, str(txt)).collect()
    assert [(r.document_id, r.source_type, r.bucket, r.key, r.file_path) for r in rows] == [
        ("doc1", "s3", "bucket1", "doc1.pdf", None), ("doc2", "s3", "bucket2", "dir/doc2.pdf", None),
        ("doc3", "local", None, None, "/local/path/doc3.jpg")]
    js = tmp_path / "one.json"
    js.write_text('{"document_id": "x", "source_type": "s3", "source": "s3://b/x.pdf", "bucket": "b", "key": "x.pdf"}')
    arr = tmp_path / "arr.json"
    arr.write_text('[{"document_id": "y", "source_type": "local", "file_path": "/y.txt"}, {"document_id": "z"}]')
    got = sorted(r.document_id for r in D.read_file_list_json(spark, str(tmp_path / "*.json")).collect())
    assert got == ["x", "y", "z"]
    csv = tmp_path / "list.csv"
    csv.write_text("document_id,source_type,source,bucket,key,file_path,extra\n"
                   "d1,s3,s3://b/d1.pdf,b,d1.pdf,,e1\nd2,local,/x/d2.txt,,,/x/d2.txt,e2\n")
    rows = D.read_file_list(spark, str(csv)).collect()
    assert [(r.document_id, r.bucket, r.file_path, r.extra) for r in rows] == [
        ("d1", "b", None, "e1"), ("d2", None, "/x/d2.txt", "e2")]


def test_extract_documents_one_scan(spark, tree):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tree)

    def pdf_fn(b):
        return "pdf text"

    def remote_ocr(b):
        raise RuntimeError("denied")

    def local_ocr(b):
        return "ocr text"

    out = X.extract_documents(files, {"pdf": [pdf_fn], "image": [remote_ocr, local_ocr]})
    got = {os.path.relpath(r.path.replace("file:", ""), tree): (r.extractor, r.text, r.extraction_error)
           for r in out.collect()}
    assert got["a/sub/report.PDF"] == ("pdf", "pdf text", None)
    assert got["b/scan.jpg"] == ("image", "ocr text", None)
    assert got["b/memo.docx"] == ("docx", "Memo line one\nline two", None)
    assert got["a/invoice.txt"][1] == "Invoice 😀\nAmount due\n"
    assert got["b/data.bin"][2].startswith("Unsupported file format: .bin")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan binaryFile") == 1  # one scan feeds every extractor
    none = X.extract_documents(files).where("extractor = 'pdf'").first()
    assert none.text is None and none.extraction_error == "no extractor configured for pdf"


def test_run_batch_writes_and_reports(spark, tmp_path):
    from doctriage.operators.score import function_scorer
    from doctriage.plans.batch import run_batch

    docs = D.conform(spark.createDataFrame(
        [("a", "direct://text-input", "text", "Invoice 1"), (None, "s3://b/k/x.pdf", "s3", None),
         ("c", "/local/c.txt", "local", None)],
        "document_id string, source string, source_type string, text string"))

    def fn(prompt):
        if "Invoice" in prompt:
            return '{"predicted_type": "invoice", "confidence_score": 0.95}'
        return "no idea"

    recs, summary, outcome = run_batch(docs, function_scorer(fn), "m", output_dir=str(tmp_path / "out"), fmt="both")
    rows = {r.document_id: r for r in recs.collect()}
    assert rows["a"].classification.document_type == "invoice" and rows["a"].cli_exit_code == 0
    assert rows["x"].classification.document_type == "unknown" and rows["x"].cli_exit_code == 1
    assert outcome.first().exit_code == 0
    assert os.path.isdir(tmp_path / "out" / "detailed") and os.path.isdir(tmp_path / "out" / "summary")
    total = summary.where("level = 'total'").first()
    assert (total.n, total.successful) == (3, 3)


def test_hour_partitions_are_pruned_on_read(spark, tmp_path):
    from doctriage.plans import fixtures as fx
    from doctriage.sinks import writers as W
    path = str(tmp_path / "by-hour")
    res = fx.results_fx(spark, "/root/testdata/sf0.001")
    W.write_by_hour(W.batch_records(res).withColumn("ts", F.to_timestamp("timestamp")), path, ts="ts")
    back = D.read_partitioned_records(spark, path, year="2024", month="01", day="02")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    expected = res.where(F.date_format("timestamp", "yyyy-MM-dd") == "2024-01-02").count()
    assert back.count() == expected > 0


def test_run_batch_scores_each_document_once(spark, tmp_path):
    from doctriage.operators.score import function_scorer
    from doctriage.plans.batch import run_batch
    calls = spark.sparkContext.accumulator(0)

    def fn(prompt):
        calls.add(1)
        return '{"predicted_type": "letter", "confidence_score": 0.8}'

    docs = D.conform(spark.createDataFrame([(f"d{i}", "direct://text-input", "text", f"text {i}") for i in range(12)],
                                           "document_id string, source string, source_type string, text string"))
    recs, summary, outcome = run_batch(docs, function_scorer(fn), "m", output_dir=str(tmp_path / "o"), fmt="both")
    recs.count(), summary.count(), outcome.collect(), recs.collect()
    assert calls.value == 12


def test_ocr_preference_chains(spark, tree):
    import pytest

    def remote(b):
        raise RuntimeError("no service")

    def local(b):
        return "local text"

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option(
        "recursiveFileLookup", "true").load(tree)
    auto = X.extract_documents(files, {"image": X.ocr_chain("auto", remote, local)}).first()
    assert auto.text == "local text"
    only_remote = X.extract_documents(files, {"image": X.ocr_chain("textract", remote, local)}).first()
    assert only_remote.text is None and "no service" in only_remote.extraction_error
    with pytest.raises(ValueError):
        X.ocr_chain("cloud", remote, local)


def test_result_location_tags(spark):
    from doctriage.sinks import writers as W
    df = spark.createDataFrame([("d1",)], "document_id string").withColumn(
        "timestamp", F.to_timestamp(F.lit("2024-03-05T07:08:09Z")))
    r = W.with_result_location(df, "classification-results/", "out", origin="doc-pipeline").first()
    assert r.result_uri == "s3://out/classification-results/classified/2024/03/05/07/d1/result.json"
    assert r.metadata_uri == "s3://out/classification-results/metadata/2024/03/05/d1/processing.json"
    assert r.tag_document_id == "d1" and r.tag_source == "doc-pipeline" and r.tag_classification_timestamp


def test_listing_with_extraction_feeds_run_batch(spark, tree):
    from doctriage.operators.score import function_scorer
    from doctriage.plans.batch import run_batch

    docs = D.list_directory(spark, tree, pattern="*.txt", extract=True)
    assert "extracted" in docs.columns and "content" not in docs.columns
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # one stage reads the files

    def fn(prompt):
        return '{"predicted_type": "invoice", "confidence_score": 0.9}' if "Invoice" in prompt else "?"

    recs, _, _ = run_batch(docs, function_scorer(fn), "m", extracted_col="extracted",
                           extraction_error_col="extraction_error")
    got = {(r.document_id, r.status, r.cli_exit_code) for r in recs.collect()}
    # invoice.txt twice (same stem, two folders), bad.txt cannot be decoded: an error row, not scored
    assert ("invoice", "success", 0) in got and ("bad", "error", 2) in got and len(got) == 3


def test_size_limit_applies_before_extraction(spark, tree):
    seen = spark.sparkContext.accumulator(0)

    def pdf_fn(b):
        seen.add(1)
        return "x"

    docs = D.list_directory(spark, tree, max_size_bytes=5, extract=True, extractors={"pdf": [pdf_fn]})
    rows = docs.collect()
    assert len(rows) == 8 and seen.value == 0  # the 19-byte PDF never reached the extractor
    assert all((r.size > 5) == (r.extraction_error or "").startswith(D.TOO_LARGE) for r in rows)
    listed = D.list_directory(spark, tree, max_size_bytes=5).collect()
    assert sorted((r.file_path, r.extraction_error is None) for r in listed) == sorted(
        (r.file_path, r.size <= 5) for r in rows)


def test_json_array_files_round_trip(spark, tmp_path):
    import glob
    import json as _json

    from doctriage.sinks import writers as W
    df = spark.createDataFrame([(f"d{i}", "success") for i in range(10)], "document_id string, status string")
    path = str(tmp_path / "arrays")
    W.write_json_arrays(df.repartition(2), path, per_file=3)
    files = [f for f in glob.glob(path + "/**/*.txt", recursive=True)]
    arrays = [_json.loads(open(f).read()) for f in files]
    assert all(isinstance(a, list) and 1 <= len(a) <= 3 for a in arrays)
    back = D.read_results(spark, path, multiline=True)
    assert sorted(r.document_id for r in back.collect()) == [f"d{i}" for i in range(10)]
