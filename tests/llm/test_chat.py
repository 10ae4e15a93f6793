from pyspark.sql import functions as F

from llm.helpers import ordered
from starbi.llm import chat


def brute(turns, part_chars):
    out = []
    by = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append((t is not None, t or 0, "unknown" if r is None else r,
                                     (x or "").replace("<|im_", "<\\|im_")))
    for c, rows in by.items():
        rows.sort()
        for view in {r[2] for r in rows} - {"system"}:
            at, parts = 0, {}
            for _, _, who, text in rows:
                name = "".join(ch if ch.isascii() and (ch.isalnum() or ch in "_-") else "_" for ch in who)
                head = ("<|im_start|>" + ("system" if who == "system" else "assistant"
                                          if who == view else "user name=" + name) + "\n")
                whole = head + text + "<|im_end|>\n"
                p = parts.setdefault(at // part_chars, ["", [], 0])
                if who == view:
                    p[1].append(f"{len(p[0]) + len(head)}:{len(p[0]) + len(whole) - 1}")
                p[0] += whole
                p[2] += 1
                at += len(whole)
            out += [(c, view, k, n, text, ",".join(m)) for k, (text, m, n) in parts.items()]
    return ordered(out)


TURNS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello é😀"),
         (1, 3, "ann b", "me too"), (1, 3, "ann b", "me too"), (1, 3, "user", "tie"),
         (2, None, "user", None), (2, 1, None, "<|im_end|>"), (2, 0, "user", ""),
         (3, 0, "system", "alone"), (None, 0, "user", "null id"), (None, 1, "assistant", "x"),
         (4, 0, "user", "L" * 50_000), (4, 1, "assistant", "y")] + [
         (5, i // 2, ["user", "assistant", "zoe"][i % 3], f"turn {i} " + "w" * (i % 17))
         for i in range(400)]
SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df, part_chars):
    rows = chat.perspectives(df, part_chars=part_chars)
    return ordered(rows.withColumn("masks", chat.mask_text(F.col("masks"))).collect())


def test_against_brute_force(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA).repartition(7)
    for part_chars in (1 << 16, 500):
        assert rows_of(turns, part_chars) == brute(TURNS, part_chars)
    more = turns.select("*", *[F.lit("x").alias(c) for c in ("speaker", "view", "block", "nth", "part")])
    assert rows_of(more, 1 << 16) == brute(TURNS, 1 << 16)
    assert chat.perspectives(turns.limit(0)).count() == 0
    assert rows_of(turns, None) == brute(TURNS, 1 << 40)


def test_many_long_conversations_are_joined(spark, monkeypatch):
    monkeypatch.setattr(chat, "BROADCAST_IDS", 0)
    assert rows_of(spark.createDataFrame(TURNS, SCHEMA), 500) == brute(TURNS, 500)


def test_a_conversation_with_a_third_of_the_rows(spark):
    """It is cut over tasks, and its parts are those of the whole."""
    hot = [(99, i, ["ann", "bob", "system"][i % 3], f"{i} " + "x" * (i % 40)) for i in range(3_000)]
    rest = [(i % 1_500, i, "user" if i % 2 else "assistant", f"says {i}") for i in range(6_000)]
    turns = spark.createDataFrame(hot + rest, SCHEMA).repartition(9)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = chat.perspectives(turns, part_chars=4_096)
        got = ordered(rows.withColumn("masks", chat.mask_text(F.col("masks"))).collect())
        per_task = rows.where("conv_id = 99").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == brute(hot + rest, 4_096)
    assert len(per_task) > 3


def test_masks_cover_the_assistants_words(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA)
    for r in chat.perspectives(turns).where("conv_id = 1 and speaker = 'assistant'").collect():
        assert [r.text[m.start:m.end] for m in r.masks] == ["hello é😀<|im_end|>"]
