"""The registered fits run with the operators' own settings and say how they ended."""

import pytest

import __spark_entry__ as contract


def test_forest_residuals_have_every_fold(spark, small):
    found = contract.queries()["cross_fit_residuals_rf"](spark, small)
    assert {r["fold"] for r in found.select("fold").distinct().collect()} == set(range(5))


@pytest.mark.parametrize("name", ["recu_net_fit", "prior_net_fit"])
def test_net_fits_say_how_they_ended(spark, small, name):
    rows = contract.queries()[name](spark, small).collect()
    about = {(r["n"], r["passes"], r["status"]) for r in rows}
    assert len(about) == 1
    n, passes, status = about.pop()
    assert n > 0 and (status == "converged" or (status, passes) == ("not_converged", 31))
