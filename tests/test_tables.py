import gzip
import json

import pytest
from pyspark.sql import functions as F

from rubrica import schemas, templates
from rubrica.functions import grade
from rubrica.functions.prompts import chat_text, message, render, safety_judge_messages
from rubrica.operators import curate, report
from rubrica.operators.scratch import scratch_path
from rubrica.sources import files
from rubrica.streaming import score


def test_render_is_literal_and_single_pass(column):
    got = column(lambda q, r: render("{question} [{x}] {response} {question}", question=q, response=r), [("{response}$1\\", "b"), ("a", None)])
    assert got == ["{response}$1\\ [{x}] b {response}$1\\", None]
    assert column(lambda q: render(templates.QUESTION_ONLY, question=q), ["a"]) == ["a"]


def test_chat_and_judge_text(spark):
    df = spark.createDataFrame([("q", " r ")], "q string, r string")
    row = df.select(
        safety_judge_messages(F.col("q"), F.col("r")).alias("m"),
        chat_text(F.array(message("user", F.col("r"))), begin="<b>").alias("c"),
        chat_text(F.array(message("user", F.col("r"))), add_generation_prompt=False).alias("n"),
    ).first()
    assert [m.role for m in row.m] == ["system", "user"] and row.m[1].content == "User Message: q\nAssistant Response:  r "
    assert row.c == "<b><|start_header_id|>user<|end_header_id|>\n\nr<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
    assert row.n.endswith("r<|eot_id|>")


def scored(spark):
    rows = [("p1", "<think> a", 1.0), ("p2", "b", 0.0), ("p3", " c", 1.0)]
    df = spark.createDataFrame(rows, "prompt string, generated_text string, r double")
    metrics = F.struct(F.lit(1.0).alias("format_reward"), F.col("r").alias("answer_reward"), F.col("r").alias("reward"))
    return df.withColumn("metrics", metrics)


def test_filter_and_reports(spark):
    df = scored(spark)
    assert sorted(tuple(r) for r in curate.rejection_filter(df).collect()) == [("p1", "a"), ("p3", "c")]
    r = report.metric_report(df).first()
    assert (r.n, r.sum_format_reward, r.sum_reward) == (3, 3.0, 2.0) and r.avg_reward == pytest.approx(2 / 3)
    assert tuple(report.keep_rate(df).first()) == (2, 3)
    assert report.metric_report(df.where("false")).first().avg_reward is None
    flags = df.select(F.col("r").alias("safe"), (1 - F.col("r")).alias("harm"))
    assert [tuple(x) for x in report.metric_means(flags, "safe", "harm").collect()] == [
        ("harm", pytest.approx(1 / 3)), ("safe", pytest.approx(2 / 3)),
    ]


def test_generation_report_and_win_rate(spark):
    df = spark.createDataFrame([(1.0, 10, 0.5), (1.0, 20, 0.7)], "r double, length long, entropy double")
    assert tuple(report.generation_report(df, F.col("r")).first()) == (pytest.approx(0.6), 15.0, 0.0)
    won = spark.createDataFrame([("model_1",), ("model_2",), ("model_1",), (None,)], "w string")
    assert tuple(report.win_rate(won, "w", "model_1").first()) == (pytest.approx(2 / 3), 3, 4)


def test_choice_accuracy_has_an_overall_row(spark):
    df = spark.createDataFrame([("s", "A", "A"), ("s", None, "B"), ("t", "C", "C")], "subject string, p string, a string")
    got = {r.subject: (r.accuracy, r.n) for r in report.choice_accuracy(df, "p", "a").collect()}
    assert got == {"s": (0.5, 2), "t": (1.0, 1), None: (pytest.approx(2 / 3), 3)}


def test_pairing(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(2,), (3,)], "k long")
    assert [r.k for r in curate.pair_by_key(left, right, "k").collect()] == [2]
    assert {(r.k, r.side) for r in curate.unmatched(left, right, "k").collect()} == {(1, "left"), (3, "right")}
    with pytest.raises(ValueError):
        curate.assert_complete(left, right, "k")
    curate.assert_complete(left, left, "k")


def test_fewshot(spark):
    ex = spark.createDataFrame([("s", i, f"e{i}") for i in (3, 1, 2)], "subject string, i long, t string")
    qs = spark.createDataFrame([(1, "s", "q1"), (2, "u", "q2")], "id long, subject string, q string")
    blocks = curate.fewshot_blocks(ex, "subject", "i", F.col("t"), k=2)
    got = {r.id: r.prompt for r in curate.fewshot_prompts(qs, blocks, "subject", "q", "id").collect()}
    assert got == {1: "e1\n\ne2\n\nq1", 2: "q2"}


def test_fewshot_limits_rows_before_the_shuffle(spark):
    ex = spark.range(100).select((F.col("id") % 3).alias("subject"), F.col("id").alias("i"), F.lit("x").alias("t"))
    plan = curate.fewshot_blocks(ex, "subject", "i", F.col("t"), k=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_contaminated_urls(spark):
    items = spark.createDataFrame([(1, "HTTP://www.A.com/x/#top"), (2, "https://b.com"), (3, None)], "id long, url string")
    listed = spark.createDataFrame([("a.com/x",), (" https://A.com/x ",), (None,)], "u string")
    got = {r.id: r.contaminated for r in curate.flag_contaminated(items, "url", listed, "u", "id").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_jsonl_round_trip(spark, tmp_path):
    df = scored(spark).select("prompt", F.lit(None).cast("string").alias("answer"), F.concat("generated_text", F.lit(" é\n ")).alias("generated_text"), "metrics")
    for compression in (None, "gzip"):
        path = str(tmp_path / str(compression))
        files.write_jsonl(df, path, order_by="prompt", compression=compression)
        back = files.read_jsonl(spark, path, schemas.SCORED)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        parts = sorted((tmp_path / str(compression)).glob("part-*"))
        raw = b"".join(gzip.decompress(p.read_bytes()) if compression else p.read_bytes() for p in parts)
        lines = raw.decode().split("\n")[:-1]
        assert [json.loads(x)["prompt"] for x in lines] == ["p1", "p2", "p3"]
        assert "é" in lines[0] and '"answer":null' in lines[0]


def test_broken_line_fails(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"prompt": "a"}\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_jsonl(spark, str(tmp_path / "x.jsonl"), schemas.SFT).collect()


def test_choice_files(spark, tmp_path):
    (tmp_path / "high_school_art_dev.csv").write_text('"Why ""so""?\nTell, me",a,"b,1",c,d,A\r\n"x\ny",1,2,3,4,B\n', newline="")
    (tmp_path / "bio_test.csv").write_text("q,a,b,c,d,D\n")
    rows = {(r.subject, r.split, r.answer): r for r in files.read_mcq_csv(spark, str(tmp_path / "*.csv")).collect()}
    assert set(rows) == {("high_school_art", "dev", "A"), ("high_school_art", "dev", "B"), ("bio", "test", "D")}
    first = rows["high_school_art", "dev", "A"]
    assert first.question == 'Why "so"?\nTell, me' and first.options == ["a", "b,1", "c", "d"]


def test_header_csv_lines_and_templates(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,harm_area,counter,category,prompts_final\n1,h,2,c,"a ""b"", c"\n')
    assert [r.prompts_final for r in files.read_safety_csv(spark, str(tmp_path / "s.csv")).collect()] == ['a "b", c']
    (tmp_path / "bad.csv").write_text("id,other,counter,category,prompts_final\n1,h,2,c,x\n")
    with pytest.raises(Exception):
        files.read_safety_csv(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "u.txt").write_text("b\na\nb\n\n")
    assert sorted(r.url for r in files.read_lines(spark, str(tmp_path / "u.txt"), "url").collect()) == ["a", "b"]
    (tmp_path / "t.prompt").write_text("User: {question}\nAssistant: <think>")
    assert files.read_template(spark, str(tmp_path / "t.prompt")) == "User: {question}\nAssistant: <think>"
    both = files.concat_sources(spark.range(1), spark.range(2), provenance=["x", "y"])
    assert {(r.source_name, r["count"]) for r in both.groupBy("source_name").count().collect()} == {("x", 1), ("y", 2)}


def test_scratch_uses_the_shared_folder(spark):
    assert scratch_path(spark, "t").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_stream_scores_like_the_batch(spark, tmp_path):
    schema = "id long, generated_text string, answer string"
    rows = [(i, f"<think>x</think>\n<answer>{i}.0</answer>", str(i % 3)) for i in range(6)]
    source, sink = tmp_path / "in", tmp_path / "out"
    spark.createDataFrame(rows[:4], schema).write.json(str(source))
    from pyspark.sql.types import _parse_datatype_string

    def run():
        stream = score.completion_stream(spark, str(source), _parse_datatype_string(schema))
        score.score_stream(stream, str(sink), str(tmp_path / "ck")).awaitTermination()
        return {r.id: r.metrics.reward for r in spark.read.schema(schema + ", metrics struct<reward: double>").json(str(sink)).collect()}

    assert run() == {i: float(i == i % 3) for i in range(4)}
    spark.createDataFrame(rows[4:], schema).write.mode("append").json(str(source))
    assert run() == {i: float(i == i % 3) for i in range(6)}


def test_reward_struct_has_the_fixed_schema(spark):
    df = spark.range(1).select(grade.zero_reward().alias("m"))
    assert [f.name for f in df.schema["m"].dataType] == [f.name for f in schemas.REWARD]


def test_large_csv_by_ranges_equals_the_whole_file(spark, tmp_path):
    import csv
    import random

    from rubrica import schemas
    from rubrica.sources import files

    draw = random.Random(5)
    text = lambda: "".join(draw.choice(['a', 'é', ',', '"', '\n', ' ', '""', '\n\n', 'word']) for _ in range(draw.randrange(40)))
    rows = [[f"{i}{text()}", text() + ".", "b", "c" + text(), "d", "ABCD"[i % 4]] for i in range(400)]
    path = tmp_path / "history_test.csv"
    with path.open("w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)
    limits = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        whole = files.read_mcq_csv(spark, str(path)).collect()
        ranged = files.read_mcq_csv(spark, str(path), split=True)
        assert files.csv_records(spark, str(path)).select("record").count() == 400
        assert sorted(map(str, ranged.collect())) == sorted(map(str, whole)) and len(whole) == 400
        assert {r.question: r.answer for r in ranged.collect()} == {r[0]: r[5] for r in rows}
        with (tmp_path / "safety.csv").open("w", newline="", encoding="utf-8") as f:
            f.write("\r\n" + ",".join(schemas.SAFETY_PROMPTS.names) + "\r\n")
            csv.writer(f).writerows([[str(i), "area", text() + "x", "c", text() + "y"] for i in range(200)])
        got = files.read_safety_csv(spark, str(tmp_path / "safety.csv"), split=True)
        assert got.columns == schemas.SAFETY_PROMPTS.names and {r.id for r in got.collect()} == {str(i) for i in range(200)}
        with pytest.raises(Exception, match="header differs"):
            files.read_split_csv(spark, str(path), schemas.MCQ_FILE, header=True).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
