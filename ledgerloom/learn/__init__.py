from .boost import BoostSettings, best_round, boosted_model, first_rounds, importances, score_rows
from .encoders import Encoder, EncoderModel, keep_order
from .features import FeatureMatrix, build_matrix
from .folds import assign_folds, stratified_folds
from .histogram import (
    HistogramFolds, HistogramModel, HistogramSettings, fit_models, refit, score_models, train_folds, tune_staged,
)
from .kfold import KFoldResult, refit_best, train_kfold
from .select import (
    categorical_dependence, combine_selection, correlated_groups, keep_most_important, mean_importance, select_features, tree_importances,
)
from .tuning import GRID, TUNING_FOLDS, refit_from_params, tune

__all__ = [n for n in dir() if not n.startswith("_")]
