"""Answer extraction ladder (D8) and the parser outcome matrix (D9, D10, SURVEY 2.12)."""

import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from doctriage.functions.answer_json import balanced_spans, describe_answer, find_json
from doctriage.operators.parse import parse_response

OBJ = '{"predicted_type": "invoice", "confidence_score": 0.92, "reasoning": "r"}'


def test_whole_text_first():
    assert find_json("  " + OBJ + "\n") == json.loads(OBJ)
    # a list parses at step 1 and is returned as is
    assert find_json("[1, 2]") == [1, 2]


def test_fenced_blocks():
    assert find_json("x ```json\n" + OBJ + "\n``` y")["predicted_type"] == "invoice"
    assert find_json("x ```\n" + OBJ + "\n``` y")["predicted_type"] == "invoice"


def test_first_balanced_object_that_parses():
    text = 'see {not json} then ' + OBJ + ' and {"b": 2}'
    assert find_json(text)["predicted_type"] == "invoice"


def test_depth_limit_takes_inner_span():
    assert balanced_spans("{{{{}}}}", 3) == ["{{{}}}"]
    assert balanced_spans("{{{{}}}}") == ["{{{{}}}}"]
    assert balanced_spans('a {"x": {"y": {"z": 1}}} b') == ['{"x": {"y": {"z": 1}}}']
    assert balanced_spans("{ {} ") == ["{}"]


def test_braces_in_strings_count():
    assert balanced_spans('{"a": "}"}') == ['{"a": "}']


def test_line_accumulation():
    text = 'Answer:\n  {\n "predicted_type": "memo",\n "x": [1,\n 2]}\ntrailing } }'
    # step 3 finds no parseable span (the trailing braces), step 4 accumulates lines
    assert find_json(text)["predicted_type"] == "memo"


# Fixed value: the depth-3 brace pattern the reference applies with findall.  It is the
# independent (backtracking) oracle for the linear scanner, on small random strings.
_DEPTH3 = re.compile(r"\{(?:[^{}]|(?:\{(?:[^{}]|(?:\{[^{}]*\})*)*\}))*\}")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="{}a", max_size=14))
def test_balanced_spans_property(s):
    assert balanced_spans(s, 3) == _DEPTH3.findall(s)


@pytest.mark.parametrize("answer,kind,error_start", [
    (OBJ, "ok", None),
    ('{"predicted_type": "spaceship", "confidence_score": 0.5}', "ok", None),
    ('{"confidence_score": 0.5}', "ok", None),
    ('{"predicted_type": "invoice"}', "ok", None),
    ('{"predicted_type": "invoice", "confidence_score": "0.9"}', "ok", None),
    ('{"predicted_type": "invoice", "confidence_score": true}', "ok", None),
    ('{"predicted_type": "invoice", "confidence_score": "high"}', "parse", "could not convert string to float"),
    ("I cannot classify this.", "parse", "Could not extract valid JSON from response: line 1 column 1 (char 0)"),
    ('[{"predicted_type": "invoice"}]', "batch", "'list' object has no attribute 'get'"),
    ('{"predicted_type": null}', "batch", "'NoneType' object has no attribute 'lower'"),
    ('{"predicted_type": "invoice", "confidence_score": null}', "batch", "float() argument must be"),
    ('{"predicted_type": "invoice", "confidence_score": [1]}', "batch", "float() argument must be"),
    ('"just a string"', "batch", "'str' object has no attribute 'get'"),
])
def test_describe_answer(answer, kind, error_start):
    out = describe_answer(answer)
    assert out[0] == kind
    if error_start:
        assert out[5].startswith(error_start)


def test_parse_outcome_matrix(spark):
    rows = [
        (1, OBJ),
        (2, '{"predicted_type": "INVOICE", "confidence_score": 0.8}'),
        (3, '{"predicted_type": " invoice ", "confidence_score": 0.8, "reasoning": "kept"}'),
        (4, '{"predicted_type": "invoice", "confidence_score": 1.5}'),
        (5, '{"predicted_type": "invoice", "confidence_score": -0.1}'),
        (6, '{"predicted_type": "invoice", "confidence_score": NaN}'),
        (7, "no json here"),
        (8, "[1]"),
        (9, '{"predicted_type": "memo", "confidence_score": 0.75, "extracted_features": null}'),
        (10, '{"predicted_type": "invoice", "confidence_score": "0.9"}'),
    ]
    df = spark.createDataFrame(rows, "id int, response_text string")
    out = {r.id: r for r in parse_response(df, threshold=0.8).collect()}
    assert (out[1].predicted_type, out[1].primary_score, out[1].stage, out[1].threshold) == ("invoice", 0.92, "ok", 0.8)
    assert out[2].predicted_type == "invoice"
    assert (out[3].predicted_type, out[3].primary_score, out[3].reasoning) == ("unknown", 0.8, "kept")
    for i in (4, 5, 6):
        assert out[i].stage == "parse" and out[i].primary_score == 0.0 and out[i].threshold == 0.7
        assert out[i].reasoning == ("Failed to parse classification response: "
                                    "Primary score must be between 0.0 and 1.0")
    assert out[7].reasoning.startswith("Failed to parse classification response: Could not extract")
    assert out[8].stage == "batch" and out[8].reasoning.startswith("Batch processing failed: ")
    assert out[9].predicted_type == "memo" and out[9].extracted_features is None
    assert out[10].primary_score == 0.9


@pytest.mark.parametrize("text", [
    "{" * 100_000 + "}" * 100_000,          # far deeper than 3: no span, no stack overflow
    "x{" * 100_000,                          # never closed
    '{"a": 1} ' * 20_000 + "tail",           # many spans; the first that parses wins
    "{" + "a" * 200_000 + "}",               # one long flat span
])
def test_linear_on_huge_answers(text):
    import time
    t0 = time.perf_counter()
    out = describe_answer(text)
    assert time.perf_counter() - t0 < 5.0
    assert out[0] in ("ok", "parse", "batch")


def test_huge_answer_through_spark(spark):
    df = spark.createDataFrame([("{" * 100_000 + "}" * 100_000,), ('noise ' * 30_000 + OBJ,)], "response_text string")
    out = parse_response(df).collect()
    assert out[0].stage == "parse" and out[1].predicted_type == "invoice"


def test_parse_outcome_matrix_remaining_rows(spark):
    rows = [
        (1, '{"confidence_score": 0.55, "reasoning": "r"}'),                       # type absent
        (2, '{"predicted_type": "memo", "reasoning": "r"}'),                       # score absent
        (3, '{"predicted_type": "memo", "confidence_score": true}'),               # boolean score
        (4, '{"predicted_type": "memo", "confidence_score": "high"}'),             # non-numeric string
        (5, '{"predicted_type": "memo", "confidence_score": 0.6, "extra": [1]}'),  # extra keys ignored
        (6, '{"predicted_type": 7, "confidence_score": 0.6}'),                     # type not a string
    ]
    out = {r.id: r for r in parse_response(spark.createDataFrame(rows, "id int, response_text string")).collect()}
    assert (out[1].predicted_type, out[1].primary_score, out[1].stage) == ("unknown", 0.55, "ok")
    assert (out[2].predicted_type, out[2].primary_score) == ("memo", 0.0)
    assert out[3].primary_score == 1.0
    assert out[4].stage == "parse" and out[4].reasoning == (
        "Failed to parse classification response: could not convert string to float: 'high'")
    assert (out[5].predicted_type, out[5].primary_score, out[5].stage) == ("memo", 0.6, "ok")
    assert out[6].stage == "batch" and out[6].reasoning == "Batch processing failed: 'int' object has no attribute 'lower'"
