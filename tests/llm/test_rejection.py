"""Language ID rejects texts with letters that are in no learned language."""

import random

from pyspark.sql import functions as F

from barloom.llm import langid
from barloom.llm.common import read_table
from tests.llm.test_methods import MEDIUM, frame

FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. "
POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. "
RUSSIAN = "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. "


def test_junk_and_unlearned_languages_are_rejected(spark):
    pick = random.Random(1)
    junk = " ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randrange(3, 10))) for _ in range(100))
    docs = read_table(spark, MEDIUM, "documents")
    model = langid.train(docs, F.lit(True))
    found = langid.identify(frame(spark, [junk, "asdf jkl qwerty zxcv " * 20, FINNISH * 3, POLISH * 3, RUSSIAN * 3]), model)
    assert [r.accepted for r in found.orderBy("doc_id").collect()] == [False] * 5
    real = langid.identify(docs.where("length(text) > 200"), model)
    assert real.select(F.avg(F.col("accepted").cast("int"))).first()[0] > 0.95
