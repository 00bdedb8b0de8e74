"""The tables that models are fitted on are made once, without a needless shuffle."""

import re

from panelforge.catalog import models_q as M
from panelforge.sources import benchdata as B

SF = "/root/testdata/sf0.001"


class Made(Exception):
    pass


def test_thresholds_make_the_matrix_once(spark, monkeypatch):
    made = []

    def once(spark, sf):
        if made:
            raise AssertionError("the matrix is made twice")
        made.append(sf)
        rows = spark.createDataFrame(
            [("a", float(i), 40.0 + i, i % 2, 1.0) for i in range(30)], f"country string, index double, `{M.SCORE}` double, label int, weight double"
        )
        rows = M.ML.VectorAssembler(inputCols=["index"], outputCol="features").transform(rows)
        return rows, rows, rows, ["index"]

    monkeypatch.setattr(M, "matrix", once)
    monkeypatch.setattr(M.ML, "hyper_search", lambda train, *_, **__: (M.ML.DecisionTreeRegressor(labelCol=M.SCORE).fit(train), None))
    lines = M.tuned_model_thresholds(spark, SF).collect()
    assert made == [SF] and {"regression_50", "classifier"} <= {r.approach for r in lines}


def test_line_items_of_flows_meet_their_orders_last(spark):
    plan = B.flow_readings(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [re.split(r"\W+", line.split("Join Inner,")[1])[1:3] for line in plan.splitlines() if "Join Inner," in line]
    above = [i for i, j in enumerate(joins) if any("l_orderkey" in x for x in j)]
    assert above == [0]
