"""Features of toxic texts are counted over all rows."""

from pyspark.sql import functions as F

from barloom.llm import nnpu
from tests.llm.test_methods import frame


def test_a_word_too_rare_for_the_sample_is_learned(spark):
    plain = "some quiet words about weather and gardens"
    texts = [f"{plain} {'grumbleword' if k % 20 == 0 else 'tea'}" for k in range(1200)]
    for k in range(0, 1200, 150):
        texts[k + 1] = f"{plain} zorblaxian"
    docs = frame(spark, texts)
    toxic = [(k, int("grumbleword" in t or "zorblaxian" in t)) for k, t in enumerate(texts)]
    labels = spark.createDataFrame(toxic, "doc_id long, toxic int")
    model = nnpu.train(docs, labels, F.lit(True), positives=5, unlabelled=40)
    found = nnpu.score(frame(spark, [plain, f"{plain} zorblaxian"]), model).orderBy("doc_id").collect()
    assert found[1].score > found[0].score + 0.2
