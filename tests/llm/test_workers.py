"""Python steps of a task: each has a worker of its own."""

from patloom.llm import quality
from patloom.llm.registry import table


def test_the_fit_has_one_python_step_a_task(spark, tables, monkeypatch):
    fit, plans = quality.fit, []

    def seen(labelled):
        plans.append(labelled._jdf.queryExecution().executedPlan().toString())
        return fit(labelled)

    monkeypatch.setattr(quality, "fit", seen)
    docs = table(spark, tables, "documents")
    assert quality.accepted(docs, table(spark, tables, "labels")).count() > 0
    assert len(plans) == 1 and "InArrow" not in plans[0]
