"""Templates, EOS, scoring, requests and the experiment grid."""

from pyspark.sql import functions as F

from qaprep import constants as K
from qaprep.operators import evaluate as E
from qaprep.operators import grid, prompts, requests


def test_ensure_eos(spark):
    df = spark.createDataFrame([("x</s>",), ("x",)], "a string")
    assert [r[0] for r in df.select(prompts.ensure_suffix(F.col("a"))).collect()] == ["x</s>", "x</s>"]


def test_instruction_templates(spark):
    df = spark.createDataFrame([("do", ""), ("do", "ctx")], "instruction string, input string")
    out = [r[0] for r in df.select(prompts.instruction_prompt(F.col("instruction"), F.col("input"))).collect()]
    assert out[0] == K.INSTRUCTION_NO_INPUT.format(instruction="do")
    assert out[1] == K.INSTRUCTION_WITH_INPUT.format(instruction="do", input="ctx")


def test_family_templates(spark):
    df = spark.createDataFrame([("Q?", "C.")], "q string, c string")
    r = df.select(prompts.gemma_prompt(F.col("q")).alias("g0"), prompts.gemma_prompt(F.col("q"), F.col("c")).alias("g1"),
                  prompts.llama_prompt(F.col("q")).alias("l0"), prompts.llama_prompt(F.col("q"), F.col("c")).alias("l1"),
                  prompts.plain_prompt(F.col("q")).alias("p")).first()
    assert r["g0"] == "<start_of_turn>user\nQ?<end_of_turn>\n<start_of_turn>model"
    assert r["g1"] == "<start_of_turn>user\nC.\n\nQ?<end_of_turn>\n<start_of_turn>model"
    assert r["l0"] == "<s>[INST] " + K.LLAMA_SYSTEM + "\nQ?[/INST]</s>"
    assert r["l1"] == "<s>[INST] " + K.LLAMA_SYSTEM + "\nC.\n\nQ?[/INST]</s>"
    assert r["p"] == K.PLAIN_HEAD + "\n### Question:\nQ?\n\n### Response:\n"


def test_prompt_matrix_has_eight_variants(spark):
    df = spark.createDataFrame([("i", "t", "s", "a", "q", "rc", "wd", "rnd")],
                               "idx string, type string, source string, answer string, question string, "
                               "relevant_context string, wrong_date_context string, random_context string")
    m = prompts.prompt_matrix(df)
    assert m.count() == 8
    assert {(r["family"], r["context_kind"]) for r in m.collect()} == {
        (f, k) for f in K.FAMILIES for k in K.CONTEXT_KINDS}


def test_argmax_first_tie(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "a array<double>")
    assert df.select(E.argmax(F.col("a"))).first()[0] == 1


def test_f1_without_positives_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")
    r = E.f1_scores(df).first()
    assert r["f1_binary"] == 0.0 and r["accuracy"] == 1.0 and r["f1_macro"] == 1.0


def test_f1_macro_matches_definition(spark):
    pairs = [(1, 1), (1, 0), (0, 0), (0, 1), (1, 1), (2, 2), (2, 0)]
    df = spark.createDataFrame(pairs, "label int, pred int")
    r = E.f1_scores(df).first()
    def f1(c):
        tp = sum(1 for l, p in pairs if l == c and p == c)
        a = sum(1 for l, _ in pairs if l == c)
        pr = sum(1 for _, p in pairs if p == c)
        return 0.0 if a + pr == 0 else 2 * tp / (a + pr)
    assert abs(r["f1_macro"] - sum(f1(c) for c in (0, 1, 2)) / 3) < 1e-12
    assert abs(r["f1_binary"] - f1(1)) < 1e-12


def test_window_mean_and_last_label(spark):
    df = spark.createDataFrame([(1, 0, 0, [1.0, 2.0]), (1, 1, 1, [3.0, 0.0])],
                               "idx long, window_no int, label int, logits array<double>")
    r = E.window_logit_mean(df, 2).first()
    assert r["mean_logits"] == [2.0, 1.0] and r["label"] == 1 and r["n_windows"] == 2


def test_cross_entropy(spark):
    import math
    df = spark.createDataFrame([([0.0, math.log(3.0)], 1)], "logits array<double>, label int")
    r = E.cross_entropy(df).first()
    assert abs(r["loss"] - math.log(4.0 / 3.0)) < 1e-12


def test_validation_loss_formulas(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "batch int, loss double")
    r = E.validation_loss(df).first()
    assert r["mean_of_batch_means"] == 3.5 and r["last_batch_loss"] == 5.0


def test_score_answers(spark):
    df = spark.createDataFrame([("The answer is: Paris!", "paris"), ("paris", "Paris.")], "prediction string, answer string")
    r = E.score_answers(df).collect()
    assert [(x["exact"], x["contains"]) for x in r] == [(False, True), (True, True)]


def test_benchmark_leak(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "nope not here")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(10, "xx alpha beta gamma delta epsilon zeta eta theta iota kappa yy"),
                                  (11, "alpha beta gamma"), (12, "Xalpha beta gamma delta epsilon zeta eta theta iota kappa")],
                                 "doc_id long, text string")
    got = sorted((r["item_id"], r["doc_id"]) for r in E.benchmark_leak(items, docs).collect())
    assert got == [(1, 10), (1, 12)]


def test_judge_tally(spark):
    df = spark.createDataFrame([('{"choice": 1, "argument": "x"}',), ('{"choice": 0, "argument": "y"}',), ("{bad",)],
                               "reply string")
    r = requests.judge_tally(df).first()
    assert (r["wins_1"], r["wins_2"], r["ties"], r["unparsed"], r["n"]) == (1, 0, 1, 1, 3)


def test_requests_shape(spark):
    df = spark.createDataFrame([("i0", "Q?", "A")], "idx string, question string, answer string")
    r = requests.context_requests(df, "idx").first()["request"]
    assert r["model"] == K.CHAT_MODEL and r["max_tokens"] == 1024 and r["temperature"] == 0.7
    assert r["messages"][0]["content"] == "\n" + K.CONTEXT_SYSTEM_PROMPT + "\n"
    assert r["messages"][1]["content"] == "Question: Q?\n\nAnswer: A\n\\Generated Context: "


def test_call_model_stub(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "yy")], "idx string, q string")
    req = df.select("idx", F.struct("q").alias("request"))
    out = requests.call_model(req, "idx", lambda: (lambda reqs: [str(len(r)) for r in reqs]))
    assert {r["idx"]: r["output"] for r in out.collect()} == {"a": "9", "b": "10"}


def test_grid_missing_file(spark):
    anchor = spark.range(1)
    files = [f"train/train_{m}_{c}_packed.jsonl" for m in K.GRID_MODELS for c in K.GRID_CONTEXTS] + \
            [f"dev/packed/dev_{m}_{c}_packed.jsonl" for m in K.GRID_MODELS for c in K.GRID_CONTEXTS
             if not (m == "Llama" and c == "WD_context")]
    g = grid.runnable_grid(anchor, spark.createDataFrame([(p,) for p in files], "path string")).collect()
    missing = [(r["model"], r["context"]) for r in g if r["status"] == "missing"]
    assert len(g) == 8 and missing == [("Llama", "WD_context")]


def test_request_lines_are_json(spark):
    import json
    df = spark.createDataFrame([("i0", "Q?", "A")], "idx string, question string, answer string")
    line = requests.request_lines(requests.context_requests(df, "idx"), "idx").first()["value"]
    obj = json.loads(line)
    assert obj["custom_id"] == "i0" and obj["body"]["messages"][1]["role"] == "user"


def test_score_answers_any_script_and_any_of(spark):
    from qaprep.operators import evaluate
    rows = [("日本", ["中国"]), ("日本。", ["中国", "日本"]), ("café", ["caf"]), ("!!", ["??"]), (None, ["a"]), ("a b", None),
            ("In Paris, 1999", ["london", "paris"]), ("a", [None, "a"])]
    df = spark.createDataFrame(rows, "prediction string, answers array<string>")
    got = [(r["exact"], r["contains"]) for r in evaluate.score_answers(df, gold="answers").collect()]
    assert got == [(False, False), (True, True), (False, True), (False, False), (False, False), (False, False),
                   (False, True), (True, True)]


def test_leak_matches_contains_for_items_of_any_length(spark):
    from qaprep.operators import evaluate
    docs = [(1, "concatenate strings"), (2, "in new yorkshire"), (3, "one two three four five six seven eight nine ten eleven"),
            (4, None), (5, ""), (6, "x one two three four five y  z")]
    items = [(1, "cat"), (2, "new york"), (3, ""), (4, " "), (5, None), (6, "two three four"), (7, "e two three four fiv"),
             (8, "one two three four five six seven eight nine ten"), (9, "y  z"), (10, "wo three four five six seven"),
             (1, "cat")]
    i = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["item_id"], r["doc_id"]) for r in evaluate.benchmark_leak(i, d).collect()}
    assert got == {(a, b) for a, t in items for b, x in docs if t is not None and x is not None and t in x}
