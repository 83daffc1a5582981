"""Fitted operators: held-out accuracy, reached targets, and cases that must not break them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.llm import decontaminate, mixing, textmodel, toxicity

from .fixtures import clashing, frame, made

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")
    return read("documents"), read("labels"), read("benchmark")


def test_toxicity_on_held_out_documents(spark, tables):
    docs, labels, _ = tables
    known = toxicity.toxic_labels(labels)
    held = F.col("doc_id") % 4 == 0
    model = toxicity.fit_toxicity(docs, known.where(~held))
    scored = toxicity.score_toxicity(docs, model).join(known.where(held), "doc_id")
    wrong = scored.where("toxic and label = 0").count()
    caught, all_toxic = scored.where("toxic and label = 1").count(), scored.where("label = 1").count()
    assert wrong == 0 and caught >= 0.5 * all_toxic


def test_severity_rises_with_the_grade(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        grade = i % 3
        text = list(rng.choice(words, 40)) + ["mild"] * (grade >= 1) + ["harsh"] * (grade >= 2)
        docs.append((i, " ".join(text)))
        labels.append((i, grade))
    table = spark.createDataFrame(labels, "doc_id bigint, label int")
    model = toxicity.fit_toxicity(frame(spark, docs), table.where("doc_id < 400"), grades=3)
    assert model.thresholds[0] < model.thresholds[1]
    scored = toxicity.score_toxicity(frame(spark, docs), model).join(table, "doc_id").where("doc_id >= 400")
    assert scored.where("grade = label").count() >= 0.97 * scored.count()
    means = [r.s for r in scored.groupBy("label").agg(F.avg("severity").alias("s")).orderBy("label").collect()]
    assert means[0] < 0.3 and 0.7 < means[1] < 1.3 and means[2] > 1.7


def test_ordinal_gradient_finds_the_likelihoods_top():
    """With one feature the fitted model beats its neighbours."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (500, 1)).astype(np.float32)
    y = np.clip(x[:, 0].astype(int) + rng.integers(0, 2, 500), 0, 2)
    model = textmodel.fit_ordinal(x, y, np.array([1], dtype=np.uint64), 3, ridge=0.0)

    def loss(weight, thresholds):
        at = textmodel.logistic(weight * x[:, 0][:, None] - thresholds[None, :])
        ladder = np.concatenate([np.ones((500, 1)), at, np.zeros((500, 1))], axis=1)
        return -np.log(ladder[np.arange(500), y] - ladder[np.arange(500), y + 1]).mean()

    weight, thresholds = model.weights[0, 0], model.thresholds
    best = loss(weight, thresholds)
    for step in (-0.3, 0.3):
        assert best <= loss(weight + step, thresholds) + 1e-6
        assert best <= loss(weight, thresholds + np.array([step, 0])) + 1e-6
        assert best <= loss(weight, thresholds + np.array([0, step])) + 1e-6


def test_toxicity_without_labels_or_texts(spark):
    docs = clashing(frame(spark, made()))
    none = spark.createDataFrame([], "doc_id bigint, label int")
    odd = spark.createDataFrame([(None, 1), (1003, None), (-5, 1), (1003, 0), (1003, 0)], "doc_id bigint, label int")
    for labels in (none, odd):
        model = toxicity.fit_toxicity(docs, labels)
        scored = toxicity.score_toxicity(docs, model)
        assert scored.count() == docs.count() and scored.where("toxic").isEmpty()
        kept = toxicity.drop_toxic(docs, model)
        assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.score_toxicity(docs.limit(0), model).isEmpty()


def test_drop_toxic_keeps_clean_rows(spark):
    docs = [(i, f"clean words number {i} " + ("nasty vile" if i % 5 == 0 else "kind nice")) for i in range(400)] + [(None, "vile nasty"), (1, None)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id bigint, label int")
    left = toxicity.drop_toxic(frame(spark, docs), toxicity.fit_toxicity(frame(spark, docs), labels))
    assert left.where("text like '%nasty%'").isEmpty() and left.count() == 321


def test_domains_on_held_out_documents(spark, tables):
    docs, labels, _ = tables
    known = mixing.quality_domains(labels)
    model = mixing.fit_domains(docs, known.where("doc_id % 4 <> 0"), 3)
    shares = mixing.posteriors(docs, model, list(mixing.DOMAINS)).join(known.where("doc_id % 4 = 0"), "doc_id")
    p = [F.col(f"p_{n}") for n in mixing.DOMAINS]
    assert shares.where(F.abs(p[0] + p[1] + p[2] - 1) > 1e-9).isEmpty()
    right = shares.where(F.array_position(F.array(*p), F.greatest(*p)) - 1 == F.col("label")).count()
    assert right >= 0.85 * shares.count()


def test_rates_reach_reachable_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(n), *map(float, p)) for i, (n, p) in enumerate(zip(rng.integers(0, 500, 900), rng.dirichlet([0.3, 0.2, 0.1], 900)))]
    shares = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p_a double, p_b double, p_c double")
    weights = {"a": 0.3, "b": 0.2, "c": 0.5}
    mixed = mixing.solve_rates(shares, weights, budget=0.7)
    got = mixed.rates
    assert mixed.met and mixed.steps <= 20
    total = shares.agg(F.sum("n_tokens")).first()[0]
    for name, weight in weights.items():
        reached = got.agg(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{name}"))).first()[0]
        assert abs(reached / total - 0.7 * weight) < 1e-3
    assert got.where("rate < 0").isEmpty() and got.count() == 900


ROWS = [(0, 10, 0.9, 0.1), (1, 30, 0.2, 0.8), (2, 5, 0.5, 0.5), (3, 0, 1.0, 0.0)]


def two_domains(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, n_tokens bigint, p_a double, p_b double")


def test_rates_match_plain_steps(spark):
    weights, budget = {"a": 0.6, "b": 0.4}, 0.8
    mixed = mixing.solve_rates(two_domains(spark), weights, budget, max_steps=3, tolerance=0)
    got = [r.rate for r in mixed.rates.orderBy("doc_id").collect()]
    n, p = np.array([r[1] for r in ROWS], float), np.array([r[2:] for r in ROWS])
    total, target, steps = n.sum(), np.array(list(weights.values())) * budget, np.zeros(2)
    for _ in range(3):
        rate = np.maximum(0, budget - p @ steps)
        common = (p * (n * (rate > 0))[:, None]).T @ p / total
        steps = steps + np.linalg.solve(common + 1e-9 * np.trace(common) * np.eye(2), (n * rate) @ p / total - target)
    assert np.allclose(got, np.maximum(0, budget - p @ steps), atol=2e-6)


def test_rates_at_zero_do_not_stop_the_fit(spark):
    """The document of the unwanted domain ends at zero, and the target is still met."""
    mixed = mixing.solve_rates(two_domains(spark), {"a": 0.88, "b": 0.12}, 0.8)
    rates = [r.rate for r in mixed.rates.orderBy("doc_id").collect()]
    assert mixed.met and rates[1] == 0 and min(rates) >= 0
    reached = [sum(r[1] * x * r[2 + k] for r, x in zip(ROWS, rates)) / 45 for k in (0, 1)]
    assert np.allclose(reached, [0.88 * 0.8, 0.12 * 0.8], atol=2e-4) and np.allclose(list(mixed.reached.values()), reached, atol=2e-5)


def test_a_target_out_of_reach_is_said(spark):
    mixed = mixing.solve_rates(two_domains(spark), {"a": 0.99, "b": 0.01}, 0.8)
    assert not mixed.met and mixed.reached["b"] > 0.01 * 0.8 and mixed.rates.where("rate < 0").isEmpty()
    nobody = two_domains(spark).withColumns({"p_a": F.lit(1.0), "p_b": F.lit(0.0)})
    alone = mixing.solve_rates(nobody, {"a": 0.5, "b": 0.5}, 0.8)
    assert not alone.met and abs(alone.reached["a"] - 0.4) < 1e-4 and alone.reached["b"] == 0
    assert mixing.solve_rates(nobody, {"a": 1.0, "b": 0.0}, 0.8).reached["a"] == 0.8


def test_mixing_odd_input(spark):
    docs = clashing(frame(spark, made()))
    labels = spark.createDataFrame([(None, 1), (1005, 0), (1005, 9), (1006, None)], "doc_id bigint, label int")
    model = mixing.fit_domains(docs, labels, 2)
    mixed = mixing.mix(docs, model, {"x": 1.0, "y": 1.0})
    assert mixed.columns == ["doc_id", "n_tokens", "p_x", "p_y", "rate", "target_met"] and mixed.count() == docs.count()
    assert mixing.mix(docs.limit(0), model, {"x": 1.0, "y": 0.0}).isEmpty()
    assert mixing.mix(docs.where("doc_id <= 1002"), model, {"x": 1.0, "y": 0.0}).where("rate <> 0.5").isEmpty()


ITEM = "Alice has 12 apples and gives 5 of them to her friend Robert before walking 3 km towards the old market of Lisbon."


def found(spark, docs, items=((7, ITEM),), **options):
    benchmark = spark.createDataFrame(list(items), "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_items(frame(spark, docs), benchmark, **options).collect()}


def test_reparameterised_items(spark):
    other = ITEM.replace("Alice", "Maria").replace("12", "17").replace("5", "eight").replace("Robert", "Pedro").replace("3 km", "9 miles").replace("Lisbon", "Porto")
    twisted = ITEM.replace("Alice", "Maria") + " " + "filler words come here now"
    docs = [(1, "some words before. " + ITEM + " and after it"), (2, "start " + other + " end"), (3, twisted), (4, "nothing of the kind in here"), (5, None), (6, ""), (None, ITEM)]
    got = found(spark, docs)
    assert set(got) == {(1, 7), (2, 7), (3, 7), (None, 7)}
    assert got[1, 7].exact and not got[2, 7].exact and got[1, 7].share == 1.0


def test_slots_must_agree(spark):
    item = "when the box holds 4 red balls we add 4 blue balls and later the box holds 4 more green balls than 9 yellow balls"
    swapped = item.replace("4 red", "6 red").replace("4 blue", "7 blue").replace("4 more", "8 more")
    same = item.replace("4", "6")
    got = found(spark, [(1, same), (2, swapped), (3, item)], [(1, item)])
    assert set(got) == {(1, 1), (3, 1)}


def test_part_of_an_item_is_not_enough(spark):
    half = " ".join(ITEM.split()[:11])
    assert found(spark, [(1, half)]) == {} and (1, 7) in found(spark, [(1, half)], min_share=0.3)


def test_real_passages(spark, tables):
    docs, _, benchmark = tables
    items = benchmark.collect()
    plain = {(d.doc_id, i.item_id) for d in docs.collect() for i in items if i.text in d.text}
    got = decontaminate.find_items(docs, benchmark)
    assert plain and plain <= {(r.doc_id, r.item_id) for r in got.collect()}


def test_a_full_gate_changes_nothing(spark):
    docs = [(1, "x " + ITEM), (2, "unrelated text about other things altogether")]
    assert set(found(spark, docs, gate_bits=64)) == set(found(spark, docs)) == {(1, 7)}


def test_decontaminate_odd_input(spark):
    docs = clashing(frame(spark, made() + [(1000, ITEM), (50, ITEM), (50, "clean")]))
    odd = spark.createDataFrame([(None, ITEM), (1, None), (2, ""), (3, "Too short."), (7, ITEM), (7, ITEM)], "item_id bigint, text string")
    rows = decontaminate.contamination(docs, odd).collect()
    assert len(rows) == docs.count() and {r.doc_id for r in rows if r.contaminated} == {50, 1000}
    left = decontaminate.drop_contaminated(docs, odd)
    assert left.columns == docs.columns and left.count() == docs.count() - 2
    assert [r.text for r in left.where("doc_id in (50, 1000)").orderBy("text").collect()] == [None, "clean"]
    empty = odd.limit(0)
    assert not any(r.contaminated for r in decontaminate.contamination(docs, empty).collect())
    assert decontaminate.contamination(docs.limit(0), odd).isEmpty()


def test_rows_without_id_and_with_one_id_are_judged_apart(spark):
    other = ITEM.replace("Alice", "Maria").replace("12", "17")
    docs = frame(spark, [(None, ITEM), (None, "clean text one"), (None, "clean text two"), (5, ITEM), (5, other), (5, "clean text three")])
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    left = decontaminate.drop_contaminated(docs, benchmark)
    assert sorted(r.text for r in left.collect()) == ["clean text one", "clean text three", "clean text two"]
    judged = decontaminate.contamination(docs, benchmark).collect()
    assert sorted((str(r.doc_id), r.contaminated) for r in judged) == [("5", False), ("5", True), ("5", True), ("None", False), ("None", False), ("None", True)]


def test_one_changed_word_spoils_its_windows_only(spark):
    item = "The farmer sold eggs at The market and The baker bought them there before The evening came and everyone went back home quietly that night while dogs were barking at some strangers who had just arrived by an old train"
    changed = item.replace("before The evening", "before That evening")
    got = found(spark, [(1, changed), (2, item)], [(1, item)])
    assert set(got) == {(1, 1), (2, 1)} and got[1, 1].share < 1.0 and got[2, 1].exact


def test_items_without_a_window_word_for_word(spark):
    items = [(1, "What is 12 + 30 ?"), (2, "12 km 30 km 40 km Alice Bob"), (3, "Too short"), (4, None)]
    docs = [(1, "He asked: what is 12 + 30? Nobody knew."), (2, "what is 13 + 30"), (3, "then 12 km 30 km 40 km Alice Bob ran"), (4, "then 12 km 31 km 40 km Alice Bob ran"), (5, "this is Too short"), (6, None)]
    assert set(found(spark, docs, items)) == {(1, 1), (3, 2)}


def test_number_words_of_four_languages(spark):
    for item, other in (
        ("der Bauer hat drei rote Kisten und kauft noch sieben blaue Kisten auf dem Markt", "der Bauer hat vier rote Kisten und kauft noch neun blaue Kisten auf dem Markt"),
        ("on compte trois grands arbres devant la maison et huit petits arbres derrière le mur", "on compte deux grands arbres devant la maison et cinq petits arbres derrière le mur"),
        ("la tienda vende cinco libros nuevos cada lunes y siete libros usados cada viernes", "la tienda vende ocho libros nuevos cada lunes y nueve libros usados cada viernes"),
    ):
        assert set(found(spark, [(1, other), (2, "quite another text about other things")], [(1, item)])) == {(1, 1)}
