"""Traffic threat scoring: protocol decode, size bins, port/volume/flag rules,
quantile-based flags and an additive risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.rules import bucketize, flag, onehot_decode, score
from rillet.operators.stats import max_normalize, quantile_flags

# Ports treated as attack vectors.
SUSPICIOUS_PORTS = [23, 135, 139, 445, 1433, 3389, 5900]
# Packet-size and threat bins of the source.
PACKET_EDGES = [0, 100, 500, 1500, float("inf")]
PACKET_LABELS = ["tiny", "small", "medium", "large"]
THREAT_LABELS = ["low", "medium", "high", "critical"]


def threat_edges(strict: bool = False) -> list[float]:
    """Risk bins (-1,10], (10,30], (30,60], (60,top]. The source's top edge is
    100 although scores reach 128; ``strict=True`` keeps 100 (such rows get no
    level), the default leaves the top bin open."""
    return [-1, 10, 30, 60, 100 if strict else float("inf")]


def describe(df: DataFrame) -> DataFrame:
    """Row-wise part: each derived column only when its source columns exist. Needs no statistic."""
    cols = set(df.columns)
    derived = {}
    proto_cols = [c for c in df.columns if c.startswith("protocol_type_")]
    if proto_cols:
        derived["primary_protocol"] = onehot_decode(proto_cols, [c.replace("protocol_type_", "").lower() for c in proto_cols])
    if "packet_size" in cols:
        derived["packet_category"] = bucketize("packet_size", PACKET_EDGES, PACKET_LABELS)
    if {"src_port", "dst_port"} <= cols:
        derived["uses_suspicious_port"] = flag(F.col("src_port").isin(SUSPICIOUS_PORTS)
                                               | F.col("dst_port").isin(SUSPICIOUS_PORTS))
    if {"tcp_flags_SYN", "tcp_flags_SYN-ACK"} <= cols:
        derived["potential_syn_flood"] = flag((F.col("tcp_flags_SYN") == 1) & (F.col("`tcp_flags_SYN-ACK`") == 0))
    if "label" in cols:
        derived["labeled_threat"] = F.when(F.col("label") == 1, "malicious").otherwise("benign")
    return df.withColumns(derived)


def volume_flags(df: DataFrame) -> DataFrame:
    """Statistics part: flags against quantiles over all rows, all thresholds from one set of passes."""
    cols = set(df.columns)
    specs = []
    if "packet_count_5s" in cols:
        specs.append(("high_volume_traffic", "packet_count_5s", 0.85, ">"))
    if "spectral_entropy" in cols:
        specs.append(("low_entropy_traffic", "spectral_entropy", 0.25, "<"))
    if {"spectral_entropy", "frequency_band_energy"} <= cols:
        specs += [("_entropy_low", "spectral_entropy", 0.15, "<"), ("_energy_high", "frequency_band_energy", 0.85, ">")]
    return quantile_flags(df, specs) if specs else df


def analyze(df: DataFrame) -> DataFrame:
    return volume_flags(describe(df))


# Points of each risk factor.
LABEL_POINTS, ODD_SIGNAL_POINTS, TINY_POINTS, LARGE_POINTS = 50, 10, 8, 6
FLAG_POINTS = {"uses_suspicious_port": 20, "high_volume_traffic": 15, "low_entropy_traffic": 10, "potential_syn_flood": 15}


def risk_points(df: DataFrame, strict: bool = False) -> DataFrame:
    """Additive risk from whichever factors are present, threat level, investigation flag."""
    c = F.col
    cols = set(df.columns)
    terms = []
    if "labeled_threat" in cols:
        terms.append((c("labeled_threat") == "malicious", LABEL_POINTS))
    for name, pts in FLAG_POINTS.items():
        if name in cols:
            terms.append((c(name), pts))
    if {"_entropy_low", "_energy_high"} <= cols:
        terms.append((c("_entropy_low") & c("_energy_high"), ODD_SIGNAL_POINTS))
    if "packet_size" in cols:
        terms += [(c("packet_size") < 50, TINY_POINTS), (c("packet_size") > 1400, LARGE_POINTS)]
    out = df.withColumn("risk_score", score(terms)).drop("_entropy_low", "_energy_high")
    out = out.withColumn("threat_level", bucketize("risk_score", threat_edges(strict), THREAT_LABELS))
    return out.withColumn("requires_investigation", flag(c("threat_level").isin("high", "critical")))


def risk(df: DataFrame, strict: bool = False) -> DataFrame:
    """Risk points, and confidence relative to the largest score."""
    return max_normalize(risk_points(df, strict), "risk_score", "anomaly_confidence")


def flow_threat(packets: DataFrame, strict: bool = False) -> DataFrame:
    return risk(analyze(packets), strict)
