"""Configuration dataclasses. Functions take these as arguments; nothing reads the environment."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LabelConfig:
    """Rating -> binary label rule.

    ``rating >= positive_threshold`` gives 1, else ``rating <= negative_threshold``
    gives 0, else NULL. Positive is tested first, so overlapping thresholds favour 1.
    ``zero_is_null`` turns a parsed rating of 0 into NULL (training pipeline); the
    single-machine mirror keeps 0 (and so labels it 0).
    """

    positive_threshold: int = 4
    negative_threshold: int = 2
    zero_is_null: bool = True
    min_text_length: int = 5  # rows need length(review_combined) > min_text_length


@dataclass(frozen=True)
class SplitConfig:
    test_ratio: float = 0.2
    seed: int = 42
    folds: int = 3
    # 2^bucket_bits hash buckets for the exact stratified split: the per-bucket
    # offset table has (#labels x 2^bucket_bits) rows, which bounds its broadcast.
    bucket_bits: int = 16


@dataclass(frozen=True)
class TrainConfig:
    """The 5-stage pipeline and its tuning.

    ``num_features`` hashed buckets; IDF ignores terms in fewer than
    ``min_doc_freq`` documents; L-BFGS runs at most ``max_iter`` iterations; the
    grid is ``reg_params`` x ``elastic_net_params`` (elastic net 0 = pure L2);
    ``parallelism`` (fold, params) fits run at once in driver threads;
    ``keep_negations`` keeps no/nor/not and n't forms out of the stop list;
    ``cv_num_bins`` is the CV evaluator's ROC binning; ``split`` gives the test
    ratio, seed and fold count.
    """

    num_features: int = 1 << 16
    min_doc_freq: int = 2
    max_iter: int = 100
    reg_params: tuple[float, ...] = (0.01, 0.1)
    elastic_net_params: tuple[float, ...] = (0.0, 0.5)
    parallelism: int = 8  # concurrent (fold, params) fits: each L-BFGS iteration is a small job
    keep_negations: bool = False
    cv_num_bins: int = 0  # numBins of the CV evaluator (areaUnderROC); 0 keeps every distinct score
    split: SplitConfig = field(default_factory=SplitConfig)
