"""Causal and shape-safe effect estimation as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from subvent.functions.activation import recu, recu_slope  # noqa: E402
from subvent.operators.causal.bins import bin_features  # noqa: E402
from subvent.operators.causal.draws import Draws, honest_draws  # noqa: E402
from subvent.operators.causal.effect import iv_effect  # noqa: E402
from subvent.operators.causal.forest import (  # noqa: E402
    IVForest,
    causal_forest_fit,
    iv_forest_fit,
    iv_forest_predict,
    iv_forest_variance,
)
from subvent.operators.causal.panel import experiment_panel  # noqa: E402
from subvent.operators.causal.residuals import cross_fit_residuals  # noqa: E402
from subvent.operators.causal.split import iv_split  # noqa: E402
from subvent.operators.prior.curve import prior_curve_fit  # noqa: E402
from subvent.operators.prior.net import prior_net_fit  # noqa: E402
from subvent.operators.prior.priors import Prior, collocation_points, prior_residuals  # noqa: E402
from subvent.operators.prior.report import generalization_report  # noqa: E402
from subvent.operators.shape.audit import shape_audit  # noqa: E402
from subvent.operators.shape.basis import CurveBasis, recu_basis  # noqa: E402
from subvent.operators.shape.curve import ShapeCurves, curve_predict, shape_curve_fit  # noqa: E402
from subvent.operators.shape.gram import gram  # noqa: E402
from subvent.operators.shape.net import RecuNet, recu_net_fit, recu_net_predict  # noqa: E402
from subvent.operators.shape.nets import RecuNets  # noqa: E402

__all__ = [
    "CurveBasis", "Draws", "IVForest", "Prior", "RecuNet", "RecuNets", "ShapeCurves", "bin_features", "causal_forest_fit",
    "collocation_points", "cross_fit_residuals", "curve_predict", "experiment_panel", "generalization_report",
    "gram", "honest_draws", "iv_effect", "iv_forest_fit", "iv_forest_predict", "iv_forest_variance", "iv_split",
    "prior_curve_fit", "prior_net_fit", "prior_residuals", "recu", "recu_basis", "recu_net_fit", "recu_net_predict",
    "recu_slope", "shape_audit", "shape_curve_fit",
]
