"""Fit, apply, save and load the factor model."""

import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession

from shelfwise.schemas import MAX_ITER, RANK, REG_PARAM
from shelfwise.session import scratch_path, use_checkpoints


@dataclass(frozen=True)
class AlsSettings:
    """Settings of one fit.

    ``ratings_per_block`` sizes the blocks once the default number of ten would make them
    too large, unless ``n_blocks`` gives their number. Grouping the ratings keeps a small buffer
    for each pair of a user block and an item block in every task, so a fit that would need more
    than ``max_blocks`` fails before it starts; larger blocks, or a larger limit for larger
    executors, are the caller's choice.
    ``checkpoint_interval`` bounds what a lost executor costs.
    """

    rank: int = RANK
    max_iter: int = MAX_ITER
    reg_param: float = REG_PARAM
    cold_start: str = "drop"
    checkpoint_interval: int = 5
    ratings_per_block: int = 2_000_000
    max_blocks: int = 1000
    n_blocks: int | None = None

    def blocks(self, ratings: int) -> int:
        needed = self.n_blocks or max(10, math.ceil(ratings / self.ratings_per_block))
        if needed > self.max_blocks:
            raise ValueError(
                f"{ratings} ratings need {needed} blocks and max_blocks is {self.max_blocks}: "
                "raise it, or ratings_per_block"
            )
        return needed

    def estimator(self, ratings: int) -> ALS:
        blocks = self.blocks(ratings)
        return ALS(
            userCol="user_id_int", itemCol="product_id_int", ratingCol="rating",
            rank=self.rank, maxIter=self.max_iter, regParam=self.reg_param,
            coldStartStrategy=self.cold_start, numUserBlocks=blocks, numItemBlocks=blocks,
            checkpointInterval=self.checkpoint_interval,
        )


def settings_report(settings: AlsSettings, ratings: int) -> dict[str, str]:
    """Every parameter of the estimator a fit on ``ratings`` rows uses, by name."""
    params = settings.estimator(ratings).extractParamMap()
    return {p.name: str(v) for p, v in params.items()}


def fit(train: DataFrame, settings: AlsSettings = AlsSettings()) -> ALSModel:
    """Fit on a written table of encoded ratings."""
    use_checkpoints(train.sparkSession)
    return settings.estimator(train.count()).fit(train)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> ALSModel:
    return ALSModel.load(path)


def fit_and_store(train: DataFrame, settings=AlsSettings(), path: str | None = None) -> ALSModel:
    """Fit, save and load again, so that later steps read factors from files."""
    spark = train.sparkSession
    path = path or scratch_path(spark, "model")
    save_model(fit(train, settings), path)
    return load_model(spark, path)


def predict(model: ALSModel, encoded: DataFrame, cold_start: str | None = None) -> DataFrame:
    """Encoded rows with a ``prediction``; ``cold_start`` overrides the strategy of the model."""
    if cold_start:
        model = model.copy().setColdStartStrategy(cold_start)
    return model.transform(encoded)
