import hashlib

from pyspark.sql import functions as F

from shelfmark.llm.chat import PLANTED, chat_digest, escaped, prefix_targets, read_back, unescaped

SCHEMA = "conv_id long, turn long, role string, text string, whole int"
ROWS = [
    (1, 2, "assistant", "two <b>", 1), (1, 1, "user", "one", 1), (1, 3, "user", "three", 1), (1, 4, "assistant", "", 1),
    (2, 1, "user", "alone\n", 1),
    (3, 1, "assistant", None, 1), (3, 1, None, "tie", 1), (3, 1, "assistant", None, 1),
    (None, 1, "user", PLANTED, 1), (None, 2, "assistant", PLANTED, 1),
    (4, None, "assistant", "\\l\\s\\g\\\\<turn x></turn>\n", 1), (4, 7, "sys>tem", "end", 1),
    (5, 1, "user", "x" * 200_000, 1), (5, 2, "assistant", "é𝄞", 1),
]


def expected():
    convs = {}
    for conv, turn, role, text, _ in ROWS:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}


def test_escaping_is_reversible_and_hides_marks(spark):
    texts = ["", "\\", "\\s", "\\l", "<\\g>", "\\\\l<", PLANTED, "</turn>\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"]
        assert "<" not in r["e"] and ">" not in r["e"]


def test_examples_hold_all_preceding_turns_and_mask_one_reply(spark):
    got = prefix_targets(spark.createDataFrame(ROWS, SCHEMA)).where("conv_id = 1").orderBy("example").collect()
    assert [r["example"] for r in got] == [1, 3]
    first, second = got
    assert first["formatted"] == "<turn user>one</turn>\n<turn assistant>two \\lb\\g</turn>\n"
    assert second["formatted"].startswith(first["formatted"])
    assert first["formatted"][first["loss_start"] :][: first["loss_length"]] == "two \\lb\\g"
    assert second["loss_length"] == 0


def test_everything_reads_back(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    got = {r["conv_id"]: r for r in read_back(prefix_targets(rows)).collect()}
    wanted = expected()
    assert set(got) == set(wanted)
    for conv, turns in wanted.items():
        assert [tuple(t) for t in got[conv]["turns"]] == turns
        assert got[conv]["loss_text"] == "".join(t for r, t in turns if r == "assistant")


def test_digests(spark):
    got = {r["conv_id"]: r for r in chat_digest(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    for conv, turns in expected().items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_no_rows(spark):
    assert chat_digest(spark.createDataFrame([], SCHEMA)).count() == 0
