import hashlib
import random

from pyspark.sql import functions as F

from tripmart.llm import chat

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\n", "<", "/s>", "é", "😀", " a ", "[", "SYS>>", "</s>\n", "<s>user\n"]


def rows_of(seed):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 8)))
    return [(c, t, rng.choice(["user", "assistant", "system", text()]), rng.choice([text(), text(), None])) for c in range(60) for t in range(rng.randrange(1, 9))]


def check(spark, rows, df=None):
    df = df if df is not None else spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    formatted = chat.format_chats(df)
    got = {r.conv_id: r for r in formatted.collect()}
    digests = {r.conv_id: r for r in chat.digests(formatted).collect()}
    chats = {}
    for c, t, role, text in rows:
        chats.setdefault(c, []).append((t if t is not None else -(10**9), role or "", text or ""))
    assert set(got) == set(chats)
    for c, turns in chats.items():
        turns = [x[1:] for x in sorted(turns)]
        assert chat.parse(got[c].formatted) == turns
        learned = [text for role, text in turns if role == "assistant"]
        assert [chat.unescaped(got[c].formatted[s.start : s.end]) for s in got[c].loss] == learned
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert digests[c].loss_chars == len("".join(learned)) and digests[c].formatted_chars == len(got[c].formatted)
        inside = got[c].formatted.split("</s>\n")[:-1]
        assert len(inside) == len(turns) and not any(control in part[3:] for part in inside for control in chat.CONTROL)


def test_round_trip(spark):
    check(spark, rows_of(1))


def test_conversation_over_many_batches(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    check(spark, rows_of(2) + [(1000, t, "assistant", f"{t}</s>") for t in range(200)])


def test_edges(spark):
    check(spark, [(None, None, None, None), (None, 1, "assistant", "x"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a")])
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(empty).count() == 0
    more = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string").withColumn("loss", F.lit(1))
    check(spark, [(1, 0, "user", "x")], more)
