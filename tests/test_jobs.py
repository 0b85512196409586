import json

import pytest

from rubrica import jobs, templates


def put(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def lines(path):
    return [json.loads(x) for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]


def test_evaluate_then_filter(spark, tmp_path):
    problems = put(tmp_path / "p.jsonl", [
        {"item_id": 0, "problem": "1+1?", "solution": "It is $\\boxed{2}$."},
        {"item_id": 1, "problem": "half {question}", "solution": "\\boxed{\\frac12}"},
        {"item_id": 2, "problem": "3?", "solution": "\\boxed{3}"},
    ])
    completions = put(tmp_path / "c.jsonl", [
        {"item_id": 1, "generated_text": "<think> hm </think>\n<answer>0.5</answer>"},
        {"item_id": 0, "generated_text": "no tags 2"},
    ])
    jobs.render_problems(spark, problems, str(tmp_path / "prompts"))
    assert [r["prompt"] for r in lines(tmp_path / "prompts")][1] == templates.R1_ZERO.replace("{question}", "half {question}")
    r = jobs.evaluate(spark, problems, completions, str(tmp_path / "scored")).first()
    assert (r.n, r.sum_format_reward, r.sum_reward) == (3, 1.0, 1.0)
    scored = lines(tmp_path / "scored")
    assert [s["item_id"] for s in scored] == [0, 1, 2] and scored[2]["generated_text"] == ""
    assert scored[1]["generated_text"] == "<think> hm </think> <answer>0.5</answer>"
    kept = jobs.build_sft(spark, str(tmp_path / "scored"), str(tmp_path / "sft")).first()
    assert tuple(kept) == (1, 3)
    assert lines(tmp_path / "sft") == [{"prompt": scored[1]["prompt"], "output": "hm </think> <answer>0.5</answer>"}]


def test_split(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "d"))
    jobs.split_dataset(spark, str(tmp_path / "d"), "id", str(tmp_path / "t"), str(tmp_path / "v"))
    assert sorted(r["id"] for r in lines(tmp_path / "t")) == list(range(6))
    assert sorted(r["id"] for r in lines(tmp_path / "v")) == [6, 7, 8, 9]


def test_safety(spark, tmp_path):
    predictions = put(tmp_path / "p.jsonl", [{"item_id": i, "prompts_final": f"q{i}", "output": f"o{i}"} for i in range(4)])
    judgements = put(tmp_path / "j.jsonl", [{"item_id": i, "model_response": " True" if i == 2 else "False"} for i in range(4)])
    jobs.render_safety_prompts(spark, predictions, str(tmp_path / "prompts"))
    assert "User Message: q3\nAssistant Response: o3" in lines(tmp_path / "prompts")[3]["model_prompt"]
    row = jobs.judge_safety(spark, predictions, judgements, str(tmp_path / "out"), "judge").first()
    assert tuple(row) == ("safe", 0.75)
    assert [r["metrics"]["safe"] for r in lines(tmp_path / "out")] == [1.0, 1.0, 0.0, 1.0]
    short = put(tmp_path / "short.jsonl", [{"item_id": 0, "model_response": "False"}])
    with pytest.raises(ValueError):
        jobs.judge_safety(spark, predictions, short, str(tmp_path / "out2"), "judge")


def test_evaluate_with_a_reward_of_the_user(spark, tmp_path):
    from rubrica.functions import grade

    problems = put(tmp_path / "p.jsonl", [{"item_id": i, "problem": "q", "solution": "abc"} for i in range(3)])
    completions = put(tmp_path / "c.jsonl", [{"item_id": 0, "generated_text": "abc"}, {"item_id": 1, "generated_text": ""}])
    length = grade.from_python(lambda text, truths: dict.fromkeys(["format_reward", "answer_reward", "reward"], float(len(text))))
    got = jobs.evaluate(spark, problems, completions, str(tmp_path / "scored"), reward=length).first()
    assert (got.n, got.sum_reward) == (3, 3.0)


def test_rollouts_to_losses(spark, tmp_path):
    import math

    problems = put(tmp_path / "p.jsonl", [{"item_id": i, "problem": f"{i}+1?", "solution": str(i + 1)} for i in range(3)])
    said = lambda a: f"<think> so </think> <answer>{a}</answer>"
    rows = [{"item_id": i, "rollout": r, "generated_text": said(i + (r % 2))} for i in range(3) for r in range(4)]
    completions = put(tmp_path / "c.jsonl", rows[:-1])
    got = jobs.build_rollouts(spark, problems, completions, str(tmp_path / "scored"), group_size=4).first()
    assert (got.n, got.sum_reward) == (11, 5.0)
    scored = {(r["item_id"], r["rollout"]): r for r in lines(tmp_path / "scored")}
    std = math.sqrt(1 / 3)
    for (i, r), row in scored.items():
        want = 0.0 if i == 2 else (r % 2 - 0.5) / (std + 1e-6)
        assert row["raw_reward"] == r % 2 and row["advantage"] == pytest.approx(want)
    tokens = [(i, r, p, -0.1 * (p + 1), p > 0) for i, r in scored for p in range(3)]
    spark.createDataFrame(tokens, "item_id long, rollout long, pos long, lp double, mask boolean").write.parquet(str(tmp_path / "policy"))
    old = [(i, r, p, lp - 0.5) for i, r, p, lp, _ in tokens]
    spark.createDataFrame(old, "item_id long, rollout long, pos long, lp double").write.parquet(str(tmp_path / "old"))
    out = jobs.policy_losses(
        spark, str(tmp_path / "scored"), str(tmp_path / "policy"), str(tmp_path / "old"), str(tmp_path / "losses"), accumulation=2, batch_rollouts=4
    ).collect()
    ratio = math.exp(0.5)
    for row in out:
        members = sorted(scored)[4 * row.batch_id : 4 * row.batch_id + 4]
        terms = [-min(ratio * scored[m]["advantage"], min(max(ratio, 0.8), 1.2) * scored[m]["advantage"]) for m in members for _ in range(2)]
        assert row.tokens == len(terms) and row.loss == pytest.approx(sum(terms) / len(terms) / 2)
    assert [r.batch_id for r in out] == [0, 1, 2]


def test_sft_batches(spark, tmp_path):
    rows = [{"item_id": i, "prompt_ids": [1] * (i + 1), "output_ids": [2, 3]} for i in range(5)]
    jobs.build_sft_batches(spark, put(tmp_path / "t.jsonl", rows), str(tmp_path / "out"), batch_size=2, pad_id=9)
    got = {r["item_id"]: r for r in lines(tmp_path / "out")}
    assert [(r["batch_id"], r["slot"]) for _, r in sorted(got.items())] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    assert got[0]["input_ids"] == [1, 2, 3] and got[0]["labels"] == [2, 3, 9] and got[0]["response_mask"] == [True, True, False]
    assert got[4]["input_ids"] == [1, 1, 1, 1, 1, 2]


def test_generation_log(spark, tmp_path):
    rows = [{"item_id": i, "prompt": "p", "answer": "5", "generated_text": f"<think> a </think> <answer>{5 + i % 2}</answer>"} for i in range(4)]
    tokens = [(i, 0.5 * i + p, p < 2) for i in range(3) for p in range(3)]
    spark.createDataFrame(tokens, "item_id long, entropy double, mask boolean").write.parquet(str(tmp_path / "tokens"))
    report = jobs.log_generations(spark, put(tmp_path / "g.jsonl", rows), str(tmp_path / "tokens"), str(tmp_path / "log")).first()
    log = lines(tmp_path / "log")
    assert [r["length"] for r in log] == [2, 2, 2, 0] and [r["entropy"] for r in log] == [0.5, 1.0, 1.5, None]
    assert [r["metrics"]["reward"] for r in log] == [1.0, 0.0, 1.0, 0.0] and log[0]["prompt"] == "p"
    assert (report.average_entropy, report.average_correct_length, report.average_incorrect_length) == (1.0, 2.0, 1.0)


def test_bucketed_tables_meet_without_an_exchange(spark, tmp_path):
    from rubrica.operators.rollouts import align_log_probs
    from rubrica.sources.tables import write_token_table

    rows = spark.range(400).selectExpr("id div 20 as seq_id", "id % 20 as pos", "id * 0.5 as lp")
    left = write_token_table(rows, "bucketed_left", str(tmp_path / "left"), 4)
    right = write_token_table(rows.withColumn("lp", rows.lp + 1), "bucketed_right", str(tmp_path / "right"), 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        aligned = align_log_probs(left, right)
        plan = aligned._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert aligned.where("lp_old = lp + 1").count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("bucketed_left", "bucketed_right"):
            spark.sql(f"DROP TABLE {name}")
