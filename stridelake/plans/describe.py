"""Description: descriptors of a sequence from its segments' features and a reference population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions.scalars import binned, mean_of_known
from stridelake.functions.strings import summary_sentence
from stridelake.operators.aggregates import percentile_rank, weighted_mean
from stridelake.operators.sequences import Sequence
from stridelake.plans.represent import MOTION

# Name, metric, edges, closed edges, labels and phrases of descriptors with fixed bins.
FIXED = {
    "walk": [
        ("pace", "gait_speed_mps", [0.4, 0.8, 1.1], (), ["very_slow", "slow", "moderate", "fast"], ["速度很慢", "速度偏慢", "速度中等", "速度较快"]),
        ("cadence", "cadence_steps_per_min", [100, 130], (1,), ["low", "moderate", "high"], ["步频偏低", "步频中等", "步频偏高"]),
        ("step_amplitude", "step_length_mean_m", [0.2, 0.3, 0.4], (), ["very_short", "short", "medium", "long"], ["步幅很短", "步幅偏短", "步幅中等", "步幅较大"]),
        ("posture", "trunk_flexion_mean_deg", [5, 15], (), ["upright", "mild_forward_lean", "stooped"], ["姿势较直立", "轻度前倾", "前倾较明显"]),
    ],
    "turn": [
        ("extent", "turn_angle_deg", [60, 120], (), ["small", "medium", "large"], ["转身角度较小", "转身角度中等", "转身角度较大"]),
        ("speed", "mean_turn_angular_velocity_deg_s", [20, 45], (), ["slow", "moderate", "fast"], ["转身角速度偏慢", "转身角速度中等", "转身角速度较快"]),
        ("hesitation", "pre_turn_hesitation_time_sec", [0, 0.5], (0,), ["none", "mild", "marked"], ["起转前无明显迟疑", "起转前略有迟疑", "起转前迟疑较明显"]),
        ("reorientation", "en_bloc_index", [0.55, 0.85], (), ["sequential", "partially_en_bloc", "en_bloc"], ["分节式重定向较明显", "重定向部分趋于整体化", "重定向更趋整体化"]),
    ],
}

# Name, metrics (those whose rank is inverted after a minus), labels and phrases of descriptors with ranks.
RANKED = {
    "walk": [
        ("rhythm", ["step_time_variability_cv_percent", "stride_time_variability_cv_percent"], ["regular", "mildly_variable", "irregular"], ["节律较稳", "节律略有波动", "节律不规则"]),
        ("asymmetry", ["step_length_asymmetry_percent", "stride_length_asymmetry_percent"], ["symmetric", "mild", "marked"], ["左右较对称", "存在轻度不对称", "存在明显不对称"]),
        ("stability", ["double_support_percent", "trunk_ml_sway_m"], ["stable", "mild_reduction", "reduced"], ["稳定性较好", "稳定性略下降", "稳定性下降"]),
        ("coordination", ["-arm_swing_amplitude_mean_deg", "arm_swing_asymmetry_percent", "-pelvis_rotation_rom_deg"], ["preserved", "mild_reduction", "reduced"], ["协调性尚可", "协调性略下降", "协调性下降"]),
    ],
    "turn": [
        ("efficiency", ["turn_duration_sec", "turn_step_count"], ["efficient", "mild_cost", "costly"], ["耗时和步数控制较好", "耗时和步数略增", "耗时较长且步数偏多"]),
        ("smoothness", ["turn_angular_velocity_variability_cv_percent"], ["smooth", "mild_fragmentation", "fragmented"], ["转身过程较平稳", "转身略显分段", "转身分段化明显"]),
        ("compactness", ["-turn_path_compactness_deg_per_m", "turn_path_radius_m"], ["compact", "moderate", "dispersed"], ["路径较紧凑", "路径紧凑性一般", "路径较分散"]),
        ("postural_control", ["trunk_lateral_lean_during_turn_deg", "pelvis_ml_excursion_during_turn_m"], ["stable", "mild_reduction", "reduced"], ["姿势控制较稳", "姿势控制略不足", "姿势控制不足"]),
    ],
}

# The words a sentence starts with, and the descriptors in its order.
PREFIX = {"walk": "步行表现为", "turn": "转身表现为"}
SENTENCE = {
    "walk": ["pace", "step_amplitude", "rhythm", "asymmetry", "posture", "stability", "coordination"],
    "turn": ["extent", "speed", "efficiency", "hesitation", "smoothness", "compactness", "reorientation", "postural_control"],
}
EDGES = [0.40, 0.75]


def metrics_of(kind: str) -> list[str]:
    fixed = [m for _, m, *_ in FIXED[kind]]
    return list(dict.fromkeys([*fixed, *[m.lstrip("-") for _, ms, *_ in RANKED[kind] for m in ms]]))


def sequence_metrics(features: DataFrame, kind: str, seq: Sequence = MOTION) -> DataFrame:
    """Mean of each metric over a sequence's segments, weighted by duration, and the number of segments."""
    weight = F.coalesce(F.col("duration_sec"), F.lit(0.0))
    return features.groupBy(*seq.keys).agg(
        F.count("*").alias("segment_count"), *[weighted_mean(m, weight).alias(m) for m in metrics_of(kind)]
    )


def _entry(label: Column, phrase: Column, policy: str, evidence: Column) -> Column:
    entry = F.struct(label.alias("label"), phrase.alias("zh_phrase"), F.lit(policy).alias("policy"), evidence.alias("evidence"))
    return F.when(label.isNotNull(), entry)


def describe_kind(features: DataFrame, reference: DataFrame, kind: str, seq: Sequence = MOTION) -> DataFrame:
    """Per sequence: the descriptors of walking or turning (a column each, null if omitted), their names omitted, and the sentence.

    features are segments of the sequences to describe, reference those of the
    population whose values give the ranks.
    """
    ranked = [m.lstrip("-") for _, ms, *_ in RANKED[kind] for m in ms]
    inverted = tuple(m[1:] for _, ms, *_ in RANKED[kind] for m in ms if m.startswith("-"))
    df = percentile_rank(sequence_metrics(features, kind, seq), reference, ranked, list(seq.keys), inverted)
    names = []
    for name, metric, edges, closed, labels, phrases in FIXED[kind]:
        evidence = F.create_map(F.lit(metric), F.col(metric).cast("double"))
        entry = _entry(binned(metric, edges, labels, closed), binned(metric, edges, phrases, closed), "fixed_thresholds", evidence)
        df = df.withColumn(name, entry)
        names.append(name)
    for name, metrics, labels, phrases in RANKED[kind]:
        plain = [m.lstrip("-") for m in metrics]
        score = mean_of_known(*[f"{m}_rank" for m in plain])
        df = df.withColumn("_score", score)
        evidence = F.map_from_arrays(
            F.array(*[F.lit(m) for m in plain], F.lit("score")), F.array(*[F.col(m).cast("double") for m in plain], F.col("_score"))
        )
        entry = _entry(binned("_score", EDGES, labels), binned("_score", EDGES, phrases), "reference_percentile", evidence)
        df = df.withColumn(name, entry).drop("_score")
        names.append(name)
    omitted = F.array_compact(F.array(*[F.when(F.col(n).isNull(), n) for n in names]))
    sentence = summary_sentence(PREFIX[kind], [F.col(f"{n}.zh_phrase") for n in SENTENCE[kind]])
    return df.select(*seq.keys, "segment_count", *names, omitted.alias("omitted_descriptors"), sentence.alias("sentence"))


def describe(walk: DataFrame, turn: DataFrame, walk_reference: DataFrame, turn_reference: DataFrame, seq: Sequence = MOTION) -> DataFrame:
    """One row per sequence with structs walk and turn (null without such segments) and the summary text."""
    parts = []
    for kind, features, reference in (("walk", walk, walk_reference), ("turn", turn, turn_reference)):
        df = describe_kind(features, reference, kind, seq)
        parts.append(df.select(*seq.keys, F.struct(*[c for c in df.columns if c not in seq.keys]).alias(kind)))
    both = parts[0].join(parts[1], list(seq.keys), "full")
    texts = [F.when(F.col(f"{k}.sentence") != "", F.col(f"{k}.sentence")) for k in ("walk", "turn")]
    return both.withColumn("text_summary_zh", F.array_join(F.array_compact(F.array(*texts)), " "))
