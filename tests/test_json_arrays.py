"""Array files read by ranges equal ``json.load``, whatever the cut."""

import json
import random

import pytest
from pyspark.sql import functions as F

from doctriage.sources import json_arrays as J
from doctriage.sources.discover import read_file_list_json, read_results
from doctriage.sources.files import list_files

VALUES = [{"a": 'quote " and \\ and \\" ] } , ['}, {"b": [1, [2, {"c": "}"}], []]}, "plain, [string]", "\\\\", 12.5, None, True, {}, [],
          {"k": "é€😀\n\t"}, {"deep": [[[[["x,]"]]]]]}, "\\\"", {"\\": "\\\\\\"}]


def cut(data, width):
    """Records by the three-way summaries of ranges, composed as the reader does."""
    out, state, depth = [], J.OUT, 0
    for a in range(0, len(data), width):
        part = data[a:a + width]
        starts, ends = J.record_starts(part, state, depth, False)
        out += [a + s for s in starts]
        state, change = J.summary(part, state)
        depth += change
    return out, state, depth


@pytest.mark.parametrize("indent", [None, 2])
def test_starts_do_not_depend_on_the_cut(indent):
    data = json.dumps(VALUES, indent=indent, ensure_ascii=False).encode()
    whole, state, depth = cut(data, len(data))
    assert len(whole) == len(VALUES) and (state, depth) == (J.OUT, 0)
    for width in range(1, 60):
        assert cut(data, width) == (whole, J.OUT, 0)


def test_files_equal_json_load(spark, tmp_path):
    rnd = random.Random(9)
    many = [rnd.choice(VALUES) for _ in range(700)]
    (tmp_path / "many.json").write_text(json.dumps(many, ensure_ascii=False))
    (tmp_path / "pretty.json").write_text(json.dumps(VALUES, indent=3) + "\n")
    (tmp_path / "single.json").write_text(" " + json.dumps({"x": [1, 2, {"y": "z" * 500}]}))
    for name, text in (("none.json", "[]"), ("spaced.json", " [ \n ] "), ("empty.json", "")):
        (tmp_path / name).write_text(text)
    files = list_files(spark, str(tmp_path))
    for width in (37, 100, 1 << 20):
        rows = J.read_json_arrays(files, width).collect()
        by = {}
        for r in sorted(rows, key=lambda r: r.place):
            assert r.error is None
            by.setdefault(r.path.rsplit("/", 1)[1], []).append(json.loads(r.record))
        assert by == {"many.json": many, "pretty.json": VALUES, "single.json": [{"x": [1, 2, {"y": "z" * 500}]}]}
    tasks = J.read_json_arrays(files.where(F.col("path").endswith("many.json")), 100).select(F.spark_partition_id()).distinct().count()
    assert tasks > 1  # one file, many tasks


def test_bad_records_are_rows_of_their_own(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'[{"a": 1}, oops, {"b": "x\xff"}, {"c": 2}, , {"d": [1, 2}, {"e"')
    rows = sorted(J.read_json_arrays(list_files(spark, str(tmp_path)), 16).collect(), key=lambda r: r.place)
    assert [r.record for r in rows if r.record] == ['{"a": 1}', '{"c": 2}']
    assert all(r.error.startswith(J.BAD_RECORD) for r in rows if r.record is None)


def test_file_list_keeps_other_fields_and_bad_rows(spark, tmp_path):
    docs = [{"document_id": f"d{i}", "source": f"/x/{i}", "source_type": "local", "size": i, "model": {"name": "m", "n": [i]}} for i in range(50)]
    (tmp_path / "list").mkdir()
    (tmp_path / "list/a.json").write_text(json.dumps(docs))
    (tmp_path / "list/b.json").write_text(json.dumps({"document_id": "one", "source": "s"}))
    (tmp_path / "list/c.json").write_text('[{"document_id": "ok", "source": "t"}, {"document_id": ]')
    got = {r.document_id: r for r in read_file_list_json(spark, str(tmp_path / "list")).collect()}
    assert set(got) == {f"d{i}" for i in range(50)} | {"one", "ok", None}
    assert (got["d7"].size, json.loads(got["d7"].other_fields)) == (7, {"model": {"name": "m", "n": [7]}})
    assert got["one"].other_fields is None and got["one"].list_error is None
    assert got[None].list_error.startswith(J.BAD_RECORD)
    one = read_file_list_json(spark, str(tmp_path / "list/b.json"))
    assert one.count() == 1


def test_results_of_one_large_array_file(spark, tmp_path):
    records = [{"document_id": f"d{i}", "status": "success", "cli_exit_code": i % 3} for i in range(500)]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=1))
    got = read_results(spark, str(tmp_path), multiline=True)
    assert sorted((r.document_id, r.cli_exit_code) for r in got.collect()) == sorted((r["document_id"], r["cli_exit_code"]) for r in records)
