"""The local batch chain: split -> base scores -> top-K unseen -> metrics.

The reference runs this as three processes on a sample of 100 users; here it is
one DataFrame plan over every user that has test rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators import metrics, recommend, split
from recsmith.session import materialize
from recsmith.sources import fixtures

TEST_RATIO = 0.2
DEFAULT_K = 10


@dataclass
class ChainInputs:
    users: DataFrame
    items: DataFrame
    interactions: DataFrame
    train: DataFrame
    test: DataFrame
    history: DataFrame
    targets: DataFrame

    @cached_property
    def scores(self) -> DataFrame:
        """Base scores of the catalogue, written when a recommender first asks for them."""
        return materialize(recommend.base_scores(self.items, self.train))


def prepare(users: DataFrame, items: DataFrame, interactions: DataFrame,
            test_ratio: float = TEST_RATIO, min_test: int = 1) -> ChainInputs:
    # The split is filters on the stored input plus a small ranked band whose positions
    # are a function of the data: readers of the train rows re-read it instead of a full rewrite.
    # The few test rows are written once, since every metric reads them again.
    flagged = split.flag_temporal_split(interactions, test_ratio, min_test=min_test)
    train = flagged.where(~F.col("is_test")).drop("is_test")
    test = materialize(flagged.where(F.col("is_test")).drop("is_test"))
    history = recommend.user_history(train)
    targets = test.select("user_id").distinct()
    return ChainInputs(users, items, interactions, train, test, history, targets)


def prepare_fixture(spark: SparkSession, sf_dir: str, test_ratio: float = TEST_RATIO,
                    min_test: int = 1) -> ChainInputs:
    t = fixtures.tables(spark, sf_dir)
    # the mapped interactions stand for a stored table: write the mapping (a join) once
    return prepare(t["users"], t["items"], materialize(t["interactions"]), test_ratio, min_test)


def recommendations(c: ChainInputs, k: int = DEFAULT_K, keep: bool = False) -> DataFrame:
    recs = recommend.top_k_unseen(c.users, c.items, c.scores, c.history, c.targets, k)
    return materialize(recs) if keep else recs


def evaluate(c: ChainInputs, recs: DataFrame, ks=metrics.DEFAULT_KS) -> DataFrame:
    return metrics.evaluation_suite(recs, c.test, c.items, ks)
