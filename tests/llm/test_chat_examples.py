import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import compare
from corpusloom.llm import chat_examples
from corpusloom.llm.queries import TRICKY, llm_oracles, llm_queries

TURNS = [
    (1, 0, "system", "be nice"),
    (1, 1, "user", "hi"),
    (1, 2, "assistant", "hello"),
    (1, 3, "user", TRICKY),
    (1, 4, "assistant", TRICKY),
    (1, 5, "user", "left open"),
    (2, 0, "user", None),
    (3, 0, "assistant", ""),
    (3, 1, "assistant", "<\\|<|<\\\\|\n<|im_start|>user\n"),
    (4, None, None, None),
    (4, 1, "odd\nrole\\n\\<|", "x|<"),
    (5, 1, "assistant", "same"),
    (5, 1, "assistant", "same"),
    (None, 1, "assistant", "nameless"),
    (6, 0, "user", "q" * 50_000),
    (6, 1, "assistant", "|" * 50_000),
]


def turns(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1, "y") for r in rows],
        "conv_id long, turn long, role string, text string, example string, target int, pieces string",
    )


def by_hand(rows):
    conversations = {}
    for conv_id, turn, role, text in rows:
        conversations.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, items in conversations.items():
        items.sort()
        said = [(role, text) for _, _, role, text in items]
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        loss = "".join(t for r, t in said if r == "assistant")
        out[conv_id] = (
            len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def test_equals_sql(spark, small):
    name = "op8_chat_examples"
    ok, note = compare(spark, small, llm_queries()[name], llm_oracles()[name])
    assert ok, note


def test_digest_of_edges(spark):
    examples = chat_examples.chat_examples(turns(spark, TURNS))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_examples.chat_digest(examples).collect()}
    assert got == by_hand(TURNS)


def test_every_reply_is_one_example(spark):
    rows = chat_examples.chat_examples(turns(spark, TURNS)).collect()
    mine = sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: r["example"])
    assert [r["loss_chars"] for r in mine] == [5, len(TRICKY) + 2, 0]
    first = "<|im_start|>system\nbe nice<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
    assert mine[0]["text"] == first
    assert all(b["text"].startswith(a["text"]) for a, b in zip(mine, mine[1:], strict=False))
    spans = [r["text"][r["loss_start"] : r["loss_start"] + r["loss_chars"]] for r in mine]
    assert spans == ["hello", "<\\|im_end|><\\|im_start|>assistant ok", ""]
    assert all(len(re.findall(r"<\|im_start\|>", r["text"])) == r["text"].count("<|im_end|>") for r in rows)


def test_empty(spark):
    examples = chat_examples.chat_examples(turns(spark, []))
    assert examples.count() == 0 and chat_examples.chat_digest(examples).count() == 0


def test_escape_round_trip(spark):
    cells = st.text(alphabet="<|\\n\nab", max_size=12)

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(cells, cells), min_size=1, max_size=40))
    def check(pairs):
        df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, role string, text string")
        role, text = F.col("role"), F.col("text")
        rows = df.select(
            "i", chat_examples.escape_role(role).alias("r"), chat_examples.escape_text(text).alias("t"),
            chat_examples.unescape_role(chat_examples.escape_role(role)).alias("r2"),
            chat_examples.unescape_text(chat_examples.escape_text(text)).alias("t2"),
        ).collect()
        for row in rows:
            assert (row["r2"], row["t2"]) == pairs[row["i"]]
            assert "<|" not in row["t"] and "<|" not in row["r"] and "\n" not in row["r"]

    check()
