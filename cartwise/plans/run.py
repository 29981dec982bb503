"""The whole job: raw tables to voted predictions.

    spark-submit -m cartwise.plans.run --data <folder> --out <folder>
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators.clean import MARKET_BOUNDS, SHOP_REG_BOUNDS, USER_REG_BOUNDS, clean_tables
from cartwise.operators.cube import kept_cube
from cartwise.operators.log import counted_log
from cartwise.operators.windows import PUBLISHED_ENDS, WindowSpec
from cartwise.plans import dataset, labels, model, vote
from cartwise.plans.families import Inputs, all_families, fit_vocabulary
from cartwise.session import build_session, set_plan_conf
from cartwise.sources.tables import Tables, materialize, materialize_bucketed, read_tables, state_of, table_path, write_csv

# Window sets and the sets each model is trained on: fixed values.
CART_SETS = ("a", "a_test")
TRAINED_ON = {"1": ("1",), "2": ("2",), "3": ("3",), "a": ("a",), "23": ("2", "3")}


@dataclass(frozen=True)
class Plan:
    """End day per window set, bucket bounds, trees and vote of one run."""

    ends: Mapping[str, dt.date] = field(default_factory=lambda: dict(PUBLISHED_ENDS))
    user_bounds: Sequence[dt.date] = tuple(USER_REG_BOUNDS)
    shop_bounds: Sequence[dt.date] = tuple(SHOP_REG_BOUNDS)
    market_bounds: Sequence[dt.date] = tuple(MARKET_BOUNDS)
    trees: model.TreeParams = model.TreeParams()
    thresholds: Mapping[str, float] = field(default_factory=lambda: dict(vote.THRESHOLDS))
    min_votes: int = vote.MIN_VOTES


class Run:
    """Tables of one run below a shared folder.

    A table that is already there is read, not rebuilt, if it was made from the same inputs, plan and code. The log is
    scanned once, for the daily cube; ``new_days`` says that since the last run in this folder only those days of the log have
    changed, and then only they are scanned.
    """

    def __init__(
        self, spark: SparkSession, raw: Tables, folder: str, plan: Plan = Plan(), new_days: Sequence[dt.date] | None = None
    ):
        set_plan_conf(spark)
        self.spark, self.folder, self.plan = spark, folder.rstrip("/"), plan
        inputs = {name: state_of(getattr(raw, name)) for name in ("actions", "users", "shops", "products", "comments")}
        self.manifest = json.dumps({"inputs": inputs, "plan": repr(plan)})
        cleaned = clean_tables(raw, plan.user_bounds, plan.shop_bounds, plan.market_bounds)
        self.tables = Tables(
            actions=cleaned.actions,
            users=self.keep("users", cleaned.users),
            shops=self.keep("shops", cleaned.shops),
            products=self.keep("products", cleaned.products),
            comments=cleaned.comments,
        )
        log = counted_log(self.tables.actions, self.tables.products)
        state = table_path("cube", json.dumps([inputs["actions"], inputs["products"]]))
        # Days can be replaced only if the products that give them category and shop are the same.
        products = table_path(f"{self.folder}/by-products", inputs["products"])
        self.cube = kept_cube(spark, products, log, state, new_days)
        self.vocabulary = fit_vocabulary(self.tables.users)
        self._inputs: dict[str, Inputs] = {}

    def keep(self, name: str, df: DataFrame, by_user: int | None = None) -> DataFrame:
        path = f"{self.folder}/{name}"
        if by_user is None:
            return materialize(self.spark, path, lambda: df, manifest=self.manifest)
        return materialize_bucketed(self.spark, path, lambda: df, "user_id", by_user, self.manifest)

    def spec(self, name: str) -> WindowSpec:
        return WindowSpec(self.plan.ends["test" if name == "a_test" else name])

    @cached_property
    def labels(self) -> DataFrame:
        """Candidates and labels of every window set, from one pass over the cube."""
        training = {name: self.spec(name) for name in self.plan.ends if name != "test"}
        return self.keep("labels", labels.all_windows(self.cube.where("by_product = 0"), training, {"test": self.spec("test")}))

    def inputs(self, name: str) -> Inputs:
        """Inputs of a window set; sets that end on the same day share their measure tables."""
        if name not in self._inputs:
            spec = self.spec(name)

            def keep(table: str, df: DataFrame, by_user: int | None = None) -> DataFrame:
                if table.startswith(("days_", "users_")):  # the same for every window
                    return self.keep(table, df, by_user)
                by_end = table.startswith("measures_") or table == "product_comments"
                part = f"end={spec.end}" if by_end else f"set={name}"
                return self.keep(f"{part}/{table}", df, by_user)

            self._inputs[name] = Inputs(self.tables, spec, self.vocabulary, name in CART_SETS, keep, cube=self.cube)
        return self._inputs[name]

    def assembled(self, name: str) -> DataFrame:
        """Training set of a window, or scoring set of ``test`` and ``a_test``, with every column."""
        def build() -> DataFrame:
            x = self.inputs(name)
            scoring = name in ("test", "a_test")
            rows = self.labels.where(F.col("window") == ("test" if scoring else name)).drop("window")
            rows = rows.drop("label") if scoring else rows
            if x.by_user is not None:
                rows = rows.repartition(x.by_user, "user_id")
            return dataset.assemble(rows, all_families(x), x.rows_per_user, x.by_user)

        return materialize(self.spark, f"{self.folder}/set={name}/assembled", build, manifest=self.manifest)

    def model_input(self, *names: str) -> DataFrame:
        stacked = dataset.union_windows(*[self.assembled(n) for n in names])
        return dataset.drop_weak(dataset.with_differences(stacked))

    def scores(self, name: str) -> DataFrame:
        """Scores of one model on the scoring window; trains and saves the model if it has not been."""
        def build() -> DataFrame:
            fitted = model.train(self.model_input(*TRAINED_ON[name]), self.plan.trees)
            model.save(fitted, f"{self.folder}/model={name}")
            model.importance(fitted).write.mode("overwrite").parquet(f"{self.folder}/importance={name}")
            return model.score(fitted, self.model_input("a_test" if name == "a" else "test"))

        return materialize(self.spark, f"{self.folder}/scores={name}", build, manifest=self.manifest)

    def predictions(self) -> DataFrame:
        """Triples that enough models vote for, also written as CSV."""
        scores = {name: self.scores(name) for name in TRAINED_ON}
        voted = vote.majority(scores, self.plan.thresholds, self.plan.min_votes)
        voted = self.keep("predictions", voted)
        write_csv(voted, f"{self.folder}/predictions_csv")
        return voted


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--data", required=True, help="folder with action, user, shop, product and comment")
    args.add_argument("--format", default="csv", choices=("csv", "parquet"))
    args.add_argument("--out", required=True, help="folder that all executors share")
    given = args.parse_args()
    spark = build_session("cartwise")
    Run(spark, read_tables(spark, given.data, given.format), given.out).predictions()


if __name__ == "__main__":
    main()
