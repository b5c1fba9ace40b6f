import hashlib
from collections import defaultdict

from lakeledger.llm import chat
from lakeledger.llm.queries import op9_chat

NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "a<", "-b", "<-", "<--", "<", "|part|>", "\n", "", None, "é\U0001F600"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, ts in by.items():
        ts.sort()
        loss = "".join(t for _, r, t in ts if r == "assistant")
        out[conv] = (len(ts), sha("".join(f"{r}\n{t}\n" for _, r, t in ts)), len(loss), sha(loss))
    return out


def check(df, rows):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}
    assert got == brute(rows)


def test_round_trip(spark):
    rows = [(1, i, r, t) for i, t in enumerate(NASTY) for r in ("assistant",)]
    rows += [(2, i, ["user", "assistant", "assistant", "<|end|>", None][i % 5], t) for i, t in enumerate(NASTY * 2)]
    rows += [(None, 0, "user", "x"), (3, None, "assistant", "early"), (3, 0, "assistant", "late"), (4, 7, "user", "q"),
             (4, 7, "user", "q"), (4, 7, "assistant", "q"), (5, 0, "assistant", "<" * 60_000 + "é" * 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_chats(df)
    check(chat.read_back(made), rows)
    one = made.where("conv_id = 4").first().formatted
    assert one == "<|turn|>assistant<|text|>q<|end|><|turn|>user<|text|>q<|part|>q<|end|>"


def test_masks_cover_the_string(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(NASTY)]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert sum(r.chars for r in made.loss_runs) == len(made.formatted)


def test_empty(spark):
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_query_on_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    check(op9_chat(spark, "/root/testdata/sf0.001"), [*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
