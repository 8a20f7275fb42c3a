"""Thresholds, lists and dates of the four workloads, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# Required transaction columns.
REQUIRED_TRANSACTION_COLUMNS = (
    "cust_id",
    "sale_id",
    "prod_id",
    "order_date",
    "pack_date",
    "sale_revenue",
)

# Optional transaction columns with the default used when one is absent.
TRANSACTION_DEFAULTS = {
    "prod_size": "nan",
    "returned_to_shop_id": "nan",
    "sale_discount_applied": 0.0,
    "prod_brand": "unknown",
    "prod_season": "nan",
    "prod_color": "unknown",
    "prod_type_1": "unknown",
    "prod_type_3": "unknown",
    "prod_type_4": "unknown",
    "prod_type_5": "unknown",
    "prod_heel": "nan",
    "prod_material": "nan",
    "prod_print": "nan",
    "prod_clasp": "nan",
    "prod_comfort_sole": "nan",
    "prod_comfort_wear": "nan",
    "prod_web_only": 0.0,
    "prod_outlet": 0.0,
}

# Brand groups.
TOP_BRANDS = (
    "Gabor",
    "Tamaris",
    "Geox",
    "STONES and BONES",
    "Converse",
    "Nike",
    "Tommy Hilfiger",
    "adidas",
    "River Woods",
    "Timberland",
    "Marco Tozzi",
    "Scapa",
    "Hampton Bays",
    "Rieker",
    "Birkenstock",
)
PREMIUM_BRANDS = ("Tommy Hilfiger", "Timberland", "Birkenstock", "Geox")
SPORT_BRANDS = ("Nike", "adidas", "Converse")
CLASSIC_BRANDS = ("Gabor", "Tamaris", "Rieker")


@dataclass(frozen=True)
class FeatureParams:
    """Fixed values of the customer feature matrix."""

    reference_date: str = "2018-01-01"
    rare_quantile: float = 0.20
    dominant_types: tuple[str, ...] = ("boys", "girls", "men", "women")
    kids_types: tuple[str, ...] = ("boys", "girls")
    adult_types: tuple[str, ...] = ("men", "women")
    one_time_orders: int = 1
    repeat_orders: int = 2
    loyal_orders: int = 10
    high_value_revenue: float = 250.0
    high_frequency_orders: int = 5
    bought_recently_days: int = 90
    recent_3m_days: int = 90
    recent_6m_days: int = 180
    growth_fallback: float = 20.0
    growth_cap: float = 20.0
    history_years: tuple[int, ...] = (2016, 2017)
    trend_start_year: int = 2016
    trend_end_year: int = 2017
    returner_year: int = 2017
    family_min_types: int = 3
    purely_women_share: float = 1.0
    recent_collection_from: int = 2017
    old_stock_until: int = 2015
    holiday_months: tuple[int, ...] = (11, 12)
    top_brands: tuple[str, ...] = TOP_BRANDS
    premium_brands: tuple[str, ...] = PREMIUM_BRANDS
    sport_brands: tuple[str, ...] = SPORT_BRANDS
    classic_brands: tuple[str, ...] = CLASSIC_BRANDS


@dataclass(frozen=True)
class ProfileParams:
    """Fixed values of the profiling tables and binned reports."""

    target_quantiles: tuple[float, ...] = (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
    text_quality_columns: tuple[str, ...] = ("prod_size", "prod_comfort_sole")
    top_text_values: int = 20
    categorical_columns: tuple[str, ...] = (
        "prod_type_1",
        "prod_type_3",
        "prod_type_4",
        "prod_type_5",
        "prod_brand",
        "prod_color",
        "prod_season",
        "prod_heel",
        "prod_material",
        "prod_print",
        "prod_clasp",
        "prod_comfort_wear",
    )
    top_brand_count: int = 10
    top_season_count: int = 15
    quick_columns: tuple[str, ...] = (
        "n_orders",
        "n_items",
        "total_revenue_1617",
        "mean_revenue",
        "recency_days",
        "tenure_days",
        "total_discount",
        "n_unique_brands",
        "n_returns",
        "return_rate",
    )
    positive_threshold: float = 0.0
    target_bins: int = 80
    order_clip: int = 20
    order_bins: int = 20
    revenue_clip: float = 1000.0
    revenue_bins: int = 60
    recency_bins: int = 10
    spend_bins: int = 10
    frequency_edges: tuple[float, ...] = (0, 1, 2, 3, 5, 10, 1000)
    frequency_labels: tuple[str, ...] = ("1", "2", "3", "4-5", "6-10", "10+")


@dataclass(frozen=True)
class ModelParams:
    """Fixed values of splits and models, plus the sizes of the boosted fits."""

    seed: int = 11
    validation_share: float = 0.20
    ridge_alpha: float = 1.0
    tree_depth: int = 8
    tree_leaf: int = 50
    neighbours: int = 10
    forest_trees: int = 200
    forest_leaf: int = 20
    forest_depth: int = 12
    boost_rounds: int = 1000
    boost_rate: float = 0.05
    boost_depth: int = 6
    boost_leaf: int = 50
    boost_patience: int = 50
    boost_subsample: float = 0.85
    boost_columns: float = 0.85
    deep_rounds: int = 2000
    deep_rate: float = 0.03
    deep_depth: int = 7
    deep_leaf: int = 30
    deep_patience: int = 100
    fold_rounds: int = 1500
    final_rounds: int = 150
    tweedie_powers: tuple[float, ...] = (1.5, 1.7, 1.8)
    zero_grid: tuple[float, ...] = (0, 0.5, 1, 2, 3, 5, 7, 10, 15, 20, 25, 30)
    folds: int = 5
    champion_zero_below: float = 25.0
    hurdle_thresholds: tuple[float, ...] = (0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60)
    high_value_thresholds: tuple[float, ...] = (0, 50, 100, 200, 300, 500)
    min_positives: int = 100
    high_threshold: float = 200.0


@dataclass(frozen=True)
class DiagnosticParams:
    """Fixed values of the error tables."""

    cutoffs: tuple[float, ...] = (5, 20)
    actual_thresholds: tuple[float, ...] = (200, 300, 500, 700, 1000)
    actual_edges: tuple[float, ...] = (-1, 0, 50, 100, 200, 300, 500, 700, 2000)
    prediction_bins: int = 10
    top_quantile: float = 0.99
    compared_features: tuple[str, ...] = (
        "n_items",
        "n_orders",
        "total_revenue",
        "n_active_months",
        "tenure_days",
        "n_unique_brands",
        "n_unique_products",
    )
    sample_threshold: float = 800.0
    sample_rows: int = 5


@dataclass(frozen=True)
class RetrievalParams:
    """Fixed values of document building and ranking."""

    reviews_per_item: int = 5
    min_review_chars: int = 30
    review_separator: str = " ||| "
    document_tags: int = 10
    metadata_tags: int = 8
    description_chars: int = 500
    feedback_chars: int = 800
    candidates: int = 15
    matches: int = 5
    similarity_weight: float = 0.7
    approval_weight: float = 0.3
    neutral_approval: float = 0.5
    context_tags: int = 5
    context_chars: int = 200
    no_match: str = "No games matched your description."
    store_page: str = "https://store.steampowered.com/app/"


@dataclass(frozen=True)
class LabelParams:
    """Fixed values of the multi-label jobs."""

    top_labels: int = 20
    smoothing: float = 1e-5
    decision: float = 0.5
    holdout_share: float = 0.30
    test_share_of_holdout: float = 0.50
    seed: int = 42
    category_floor: int = 100
    examples: int = 3


@dataclass(frozen=True)
class Params:
    features: FeatureParams = field(default_factory=FeatureParams)
    profile: ProfileParams = field(default_factory=ProfileParams)
    models: ModelParams = field(default_factory=ModelParams)
    diagnostics: DiagnosticParams = field(default_factory=DiagnosticParams)
    retrieval: RetrievalParams = field(default_factory=RetrievalParams)
    labels: LabelParams = field(default_factory=LabelParams)
