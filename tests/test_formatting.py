"""Golden rows of the text functions and processors."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.config import SpecialTokens
from corpusloom.functions import chat, formats, text
from corpusloom.operators import prepare

TOKENS = SpecialTokens()
CHAT = "<s><|user|>\na<|end|>\n<|bot|>\nb<|end|>\n</s>"


def column(spark, values, build):
    frame = spark.createDataFrame(list(enumerate(values)), "i INT, text STRING")
    rows = frame.select("i", build(F.col("text")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


def kept(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "text STRING")
    return [row["text"] for row in prepare.drop_blank(frame).collect()]


def test_blank_rows(spark):
    blank = [None, "", "   ", " 　", "\u001c", "\t\n\x0b\x0c\r\x85 "]
    assert kept(spark, blank) == []
    assert kept(spark, ["​", "﻿", " a "]) == ["​", "﻿", " a "]


def test_strip_equals_python(spark):
    every = [chr(c) for c in range(0x3001) if not 0xD800 <= c < 0xE000]
    values = ["\t\ny \x0b", "", "a", "a b\n", "\n\na\n\n"] + [f"{c}x{c}y{c}" for c in every]
    assert column(spark, values, text.strip_unicode) == [v.strip() for v in values]


def test_strip_is_linear_in_inner_blanks(spark):
    long = "a" + " " * 200_000 + "b"
    assert column(spark, [long], text.strip_unicode) == [long]


def test_wraps(spark):
    assert column(spark, [" hi "], lambda c: formats.wrap(c, TOKENS)) == ["<s> hi </s>"]
    assert column(spark, [" hi "], lambda c: formats.strip_wrap(c, TOKENS)) == ["<s>hi</s>"]


def test_json_content(spark):
    values = ['{"content":"a"}', "bad", '{"content":5}', '{"content":null}', '{"other":1}', "[1]",
              '{"content":{"content":"a"}}', '{"content":"5"}', '"x"', '{"content":""}']
    got = column(spark, values, lambda c: formats.json_content(c, TOKENS))
    assert got == ["<s>a</s>"] + [None] * 6 + ["<s>5</s>", None, "<s></s>"]


def test_json_content_equals_python(spark):
    values = [
        '{"content":"a","content":"b"}', ' {"content":"a"} \n', '{"content":"a"} x',
        '{"content":"a"}{"content":"b"}', '{"content":"a"},{"content":"b"}',
        '{"content":"a"}],[{}', '{"content":"a"}},{"x":{}', '{"content":"a"},"value":{"content":"b"}',
        '{"content":"a\tb"}', '{"content":"\\u00e9\\n"}', "{'content':'a'}", '{"content":"a",}',
        '{"content":"a","x":01}', '{"content":"a","x":1e999}', '{"content":true}',
        '{"content":["a"]}', '\ufeff{"content":"a"}', '{"a":{"content":"x"}}', "", "[]", "{}",
        '{"content":"\\ud83d\\ude00"}', '{"content":"2020-01-01"}', '{"content":"a" /*c*/}',
    ]

    def in_python(value):
        try:
            return "<s>" + json.loads(value)["content"] + "</s>"
        except Exception:
            return None

    got = column(spark, values, lambda c: formats.json_content(c, TOKENS))
    assert got == [in_python(v) for v in values]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("<|user|> a <|end|><|bot|> b<|end|>", [("user", "a"), ("assistant", "b")]),
        ("a<|end|>b", [("user", "a"), ("assistant", "b")]),
        ("a<|end|>b<|end|>c", [("user", "a"), ("assistant", "b")]),
        (
            "a<|end|>b<|end|>c<|end|>",
            [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "")],
        ),
        ("a", []),
        ("", []),
        ("<|end|>", [("user", ""), ("assistant", "")]),
        (
            "<|bot|>x<|end|><|user|>y<|end|>",
            [("user", "<|bot|>x"), ("assistant", "<|user|>y")],
        ),
    ],
)
def test_parse_conversation(spark, value, expected):
    (got,) = column(spark, [value], lambda c: chat.parse_conversation(c, TOKENS))
    assert [tuple(message) for message in got] == expected


def test_render_and_audit(spark):
    schema = "i INT, c ARRAY<STRUCT<role: STRING, content: STRING>>"
    rows = [
        (0, [("user", "a"), ("assistant", "b")]),
        (1, [("user", "a"), ("assistant", "b"), ("user", "c")]),
        (2, [("assistant", "a"), ("user", "b")]),
        (3, [("system", "s"), ("user", "a"), ("assistant", "b")]),
        (4, []),
        (5, [("user", "a"), ("user", "b")]),
    ]
    frame = spark.createDataFrame(rows, schema).select(
        "i",
        chat.valid_alternation(F.col("c")).alias("ok"),
        chat.render_chat(F.col("c"), TOKENS).alias("prompt"),
    )
    got = {row["i"]: (row["ok"], row["prompt"]) for row in frame.collect()}
    assert [got[i][0] for i in range(6)] == [True, True, False, False, True, False]
    assert got[0][1] == CHAT
    assert got[2][1] is None and got[3][1] is None and got[5][1] is None
    assert got[4][1] == "<s>"


def test_default_processor(spark):
    values = ["a", "a<|end|>b"]
    instruct = column(spark, values, lambda c: formats.chat_or_wrap(c, F.lit(True), TOKENS))
    pretrain = column(spark, values, lambda c: formats.chat_or_wrap(c, F.lit(False), TOKENS))
    assert instruct == ["<s>a</s>", CHAT]
    assert pretrain == ["<s>a</s>", "<s>a<|end|>b</s>"]


def test_line_chat(spark):
    values = ["a\nb", "a\n\nb", "a", " a \n\n\n b"]
    got = column(spark, values, lambda c: formats.line_chat(c, F.lit(True), TOKENS))
    assert got[0] == CHAT
    assert got[1] is None
    assert got[2] == "<s><|user|>\na<|end|>\n"
    assert got[3] == "<s><|user|>\n a <|end|>\n<|bot|>\n b<|end|>\n</s>"
    plain = column(spark, ["a\n\nb"], lambda c: formats.line_chat(c, F.lit(False), TOKENS))
    assert plain == ["<s>a\n\nb</s>"]


def test_null_results_and_empty_strings(spark):
    frame = spark.createDataFrame([("x",), ("y",)], "text STRING")
    out = prepare.prepare(frame, "CASE WHEN text = 'x' THEN '' END", False)
    assert [row["text"] for row in out.collect()] == [""]


def test_sql_processor_sees_phase(spark):
    frame = spark.createDataFrame([("x",)], "text STRING")
    rule = "IF(isinst, concat(bos, text), concat(text, eos))"
    assert prepare.prepare(frame, rule, True).first()["text"] == "<s>x"
    assert prepare.prepare(frame, rule, False).first()["text"] == "x</s>"


def test_python_processor_quarantine(spark):
    def picky(value, tokens, instruct):
        if value == "bad":
            raise KeyError("content")
        return None if value == "none" else tokens.bos + value

    frame = spark.createDataFrame([(v,) for v in ["ok", "bad", "none", " ", None]], "text STRING")
    out = prepare.quarantine(frame, prepare.python_processor(picky), False)
    got = {row["text"]: (row["result"], row["reject_reason"]) for row in out.collect()}
    assert got == {
        "ok": ("<s>ok", None),
        "bad": (None, "error"),
        "none": (None, "null_result"),
        " ": (None, "blank"),
        None: (None, "blank"),
    }


def reasons(spark, values, processor):
    frame = spark.createDataFrame(list(enumerate(values)), "i INT, text STRING")
    out = prepare.quarantine(frame, processor, True)
    return [(r["result"], r["reject_reason"]) for r in out.orderBy("i").collect()]


def test_a_failing_sql_expression_rejects_the_row(spark):
    got = reasons(spark, ["12", "abc", ""], "cast(cast(text AS INT) + 1 AS STRING)")
    assert got == [("13", None), (None, "null_result"), (None, "blank")]
    assert reasons(spark, ["0", "4"], "8 div cast(text AS INT)") == [(None, "null_result"), ("2", None)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(ValueError):
        prepare.sql_processor("raise_error(text)")


def outcome(spark, values, expression):
    """Reject reasons, or the names that the expression is refused for."""
    try:
        return reasons(spark, values, expression)
    except ValueError as refused:
        return str(refused)


@pytest.mark.parametrize(
    ("expression", "good", "bad", "result"),
    [
        ("cast(parse_json(text) AS STRING)", "[1, 2]", "[1,", "[1,2]"),
        ("element_at(split(text, ' '), 2)", "a b", "a", "b"),
        ("cast(to_number(text, '999') AS STRING)", "12", "x", "12"),
        ("split_part(text, ' ', 1)", "a b", " ", "a"),
        ("split(text, ' ')[1]", "a b", "a", "b"),
        ("cast(variant_get(parse_json(text), '$.n', 'int') AS STRING)", '{"n": 4}', '{"n": "x"}', "4"),
        ("cast(to_timestamp(text) AS STRING)", "2020-01-02 03:04:05", "soon", "2020-01-02 03:04:05"),
        ("decode(1, 1, text)", "a", "", "a"),
    ],
)
def test_sql_functions_that_raise_reject_the_row(spark, expression, good, bad, result):
    got = outcome(spark, [good, bad], expression)
    if isinstance(got, str):
        assert "decode" in got
    else:
        assert got[0] == (result, None) and got[1][0] is None and got[1][1] is not None


@pytest.mark.parametrize(
    ("expression", "named"),
    [
        ("element_at(split(text, ' '), 0)", "element_at"),
        ("element_at(split(text, ' '), length(text))", "element_at"),
        ("split_part(text, ' ', 0)", "split_part"),
        ("concat(text, RAISE_ERROR (text))", "raise_error"),
        ("if(assert_true(length(text) > 3) is null, text, '')", "assert_true"),
        ("from_json(text, 'a INT', map('mode', 'FAILFAST')).a", "from_json"),
        ("regexp_extract(text, '(a', 1)", "regexp_extract"),
        ("regexp_extract(text, '(a)(b)', 3)", "regexp_extract"),
        ("regexp_replace(text, '(a)', '$2')", "regexp_replace"),
        ("regexp_replace(text, text, 'x')", "regexp_replace"),
        ("array_join(transform(split(text, ' '), x -> unbase64(x)), '')", "unbase64"),
        ("array_join(slice(split(text, ' '), length(text), 2), '')", "slice"),
        ("text LIKE text", "like"),
        ("java_method('java.lang.System', 'exit', 1)", "java_method"),
        ("cast(sequence(1, length(text), 0) AS STRING)", "sequence"),
    ],
)
def test_expressions_that_could_fail_the_job_are_refused_by_name(spark, expression, named):
    got = outcome(spark, ["a"], expression)
    assert isinstance(got, str) and named in got


@pytest.mark.parametrize(
    ("expression", "wanted"),
    [
        ("' raise_error('", " raise_error("),
        ("concat(text, ' parse_json(', \"element_at(\", '\\' assert_true(')", "a parse_json(element_at(' assert_true("),
        ("text /* raise_error(text) */", "a"),
        ("regexp_replace(text, '(a)', '<$1>')", "<a>"),
        ("CASE WHEN isinst AND text LIKE 'a%' THEN upper(text) END", "A"),
        ("array_join(transform(split(text, ''), x -> concat(x, '.')), '')", "a."),
    ],
)
def test_harmless_expressions_are_taken(spark, expression, wanted):
    assert reasons(spark, ["a"], expression) == [(wanted, None)]


def test_sql_processors_leave_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    frame = spark.createDataFrame([("a", True)], "text STRING, told BOOLEAN")
    out = prepare.prepare(frame, "if(isinst, text, cast(told AS STRING))", F.col("told"))
    assert out.first()["text"] == "a" and spark.conf.get("spark.sql.ansi.enabled") == before


def test_a_python_result_that_is_no_text_rejects_the_row(spark):
    processor = prepare.python_processor(lambda value, tokens, instruct: 5 if value == "x" else value)
    assert reasons(spark, ["x", "y"], processor) == [(None, "error"), ("y", None)]


def test_built_ins_tell_errors_from_blanks(spark):
    deep = '{"content":"deep","x":' + "[" * 1_500 + "]" * 1_500 + "}"
    long = json.dumps({"content": "a" * 20_100_000})
    got = reasons(spark, ['{"content":"a"}', "bad", '{"content":5}', " ", long], "json_content")
    assert got[:4] == [("<s>a</s>", None), (None, "error"), (None, "error"), (None, "blank")]
    assert len(got[4][0]) == 20_100_007
    ((result, _),) = reasons(spark, [deep], "json_content")
    try:
        json.loads(deep)
        assert result == "<s>deep</s>"
    except RecursionError:
        assert result is None
    assert reasons(spark, ["a\n\nb\nc"], "line_chat") == [(None, "error")]


def test_empty_batch_fails_in_strict_mode(spark):
    frame = spark.createDataFrame(
        [(i, " " if 10 <= i < 20 else "a") for i in range(25)], "doc_id BIGINT, text STRING"
    )
    survived = text.not_blank(F.col("text"))
    rows = prepare.empty_batches(frame, ["doc_id"], 10, survived).collect()
    assert [(r["batch_no"], r["n_rows"], r["n_valid"]) for r in rows] == [(1, 10, 0)]
    with pytest.raises(ValueError):
        prepare.empty_batches(frame, ["doc_id"], 10, survived, strict=True)


def test_format_metrics_rounds_like_python(spark):
    values = [0.0003, 1.23456, 0.0, 12.34125, 1.00005, 0.03125, 2.00015, -0.004, 0.01, 1e9 + 0.00005]
    frame = spark.createDataFrame(list(enumerate(values)), "step INT, loss DOUBLE")
    line = formats.format_metrics({"loss": F.col("loss")}, {"step": F.col("step")})
    got = [row["line"] for row in frame.select("step", line.alias("line")).orderBy("step").collect()]
    small = lambda v: f"{v:.2e}" if v != 0 and abs(v) < 0.01 else f"{v:.4f}"
    assert got == [f"loss: {small(v)} | step: {i}" for i, v in enumerate(values)]


def test_pretokenize(spark):
    import regex

    pattern = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )
    values = [
        "it's  été 12!x",
        "a \n\n b\t  c   ",
        "we'll x'd 'S  　中文 \U0001f600!! \x1c a",
        "",
        "   ",
    ]
    assert column(spark, values[:1], text.pretokenize) == [
        ["it", "'s", " ", " été", " 12", "!", "x"]
    ]
    assert column(spark, values, text.pretokenize) == [pattern.findall(v) for v in values]
