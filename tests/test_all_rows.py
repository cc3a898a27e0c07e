"""The solvers read the whole training window."""

import inspect

import pytest
from pyspark.sql import functions as F

from chargelens.operators import features
from chargelens.plans import training
from chargelens.sources import driver_views

SF = "/root/testdata/sf0.01"


def test_the_solvers_read_all_rows(spark):
    """There is no bound unless a caller gives one: every training row enters, with its balanced weight."""
    assert inspect.signature(training.train).parameters["fit_rows"].default is None
    assert features.draw_rates({0: 10**9, 1: 10**8}, None) == {0: 1.0, 1: 1.0}
    run = training.train_cards(driver_views.transactions(spark, SF, gaps=True), driver_views.customer_spend(spark, SF), trees=1)
    assert run.fit_rows is None and run.fitted().count() == run.train_rows == 7_500
    assert run.fitted().agg(F.sum("weight")).first()[0] == pytest.approx(7_500)
