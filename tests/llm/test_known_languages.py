"""The pipeline's language stage decides on the labelled spans."""

import random

import pytest

from shopflow.llm import lang_id

EN = "the house and the garden of the king were in the old part of the town where people came to buy bread and to talk about the weather of the week"
DE = "das haus und der garten von dem könig waren in dem alten teil der stadt wo die leute brot kauften und über das wetter der woche redeten"
HU = "a királynak szép háza és nagy kertje volt a város régi részében ahová az emberek kenyeret venni jártak és beszélgettek az időjárásról"


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(t.split(), k=120)), k) for i in range(40) for k, t in (("en", EN), ("de", DE))]
    return lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang")


def test_an_unlearned_language_in_a_learned_script_goes(spark, model):
    noise = "".join(random.Random(2).sample(EN.replace(" ", "") * 3, 300))
    rows = [(1, EN), (2, DE), (3, f"{EN}. {DE}"), (4, HU), (5, noise), (6, "the king"), (7, "123 !"), (8, None), (9, f"{EN} {DE} {HU}"), (10, f"{EN} {HU} {HU}")]
    kept = lang_id.accepted(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {r.doc_id for r in kept} == {1, 2, 3, 6, 9}


def test_learned_averages(model):
    names, _, _, averages = model
    assert names == ["de", "en"] and (averages[:, 0] > averages[:, 1] + 2).all()
