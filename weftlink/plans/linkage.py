"""The whole linkage run: normalise, block, label, featurise, train, choose a threshold, infer, write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocking, features, matcher, metrics, translit
from ..operators.normalise import blocking_columns, normalise
from ..sources import sinks


def mine(truth: DataFrame, records: DataFrame, min_count: int = translit.MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Dictionary and the one-row statistics of its mining."""
    aligned = translit.alignments(truth, records.select("entity_id", "business_name"))
    counted = translit.counts(aligned)
    kept = translit.dictionary(counted, min_count)
    return kept, translit.statistics(aligned, counted, kept)


def block(records: DataFrame, dictionary: DataFrame | None = None, sample: int = 0, seed: int = 1, **options) -> tuple[DataFrame, DataFrame]:
    """Candidates and the normalised records (records: entity_id, business_name, business_address, country, src)."""
    rows = normalise(records, dictionary)
    keys = blocking_columns(rows)
    s1 = blocking.sample(keys.where("src = 'S1'"), sample, seed)
    return blocking.candidates(s1, keys.where("src <> 'S1'"), **options), rows


def train_and_report(candidates: DataFrame, normalised: DataFrame, truth: DataFrame, val_fraction: float = 0.2, seed: int = 1, rounds: int = matcher.ROUNDS):
    """Model, its metadata, and the validation pairs with probabilities.

    Macro F0.5 is given in two scopes: ``candidate`` knows only truth that the candidates retain, ``full`` all truth of all
    validation S1 records.  The threshold is the best of the grid in candidate scope.
    """
    pairs = features.labelled(features.exploded(candidates), truth)
    unknown = features.missing_entities(pairs, normalised)
    if not unknown.isEmpty():
        raise KeyError(f"candidates name unknown ids, such as {unknown.first()[0]}")
    rows = features.features(pairs, normalised)
    split = matcher.entity_split(pairs, val_fraction, seed)
    rows = rows.join(split, "source1_entity_id").persist()
    model = matcher.train(rows, rounds=rounds, seed=seed)
    val = matcher.scored(model, rows.where("is_val")).select("source1_entity_id", "candidate_entity_id", "label", "prob").persist()
    swept = metrics.sweep(val).persist()
    best = metrics.best(swept).first()
    s1 = split.where("is_val")
    full = metrics.sweep(val, s1, truth.join(s1, "source1_entity_id", "left_semi"))
    full_best = full.where((F.col("threshold") == best["threshold"]) & (F.col("owner_exclusive") == best["owner_exclusive"])).first()
    sweeps = {m: {str(r["threshold"]): r["macro_f05"] for r in swept.where(F.col("owner_exclusive") == m).orderBy("threshold").collect()} for m in (False, True)}
    metadata = {"features": features.FEATURES, "owner_exclusive": best["owner_exclusive"], "best_threshold": best["threshold"], "val_macro_f_half_candidate_scope": best["macro_f05"], "val_macro_f_half_full_scope": full_best["macro_f05"], "val_auc": matcher.auc(model, rows.where("is_val")), "best_iteration": model.getNumTrees, "naive_threshold_sweep": sweeps[False], "owner_exclusive_threshold_sweep": sweeps[True], "feature_importance": matcher.importance(model)}
    return model, metadata, val


def infer(candidates: DataFrame, normalised: DataFrame, model, threshold: float, owner_exclusive: bool, out_dir: str | None = None) -> DataFrame:
    """Matches of any split's candidates; written as result files if ``out_dir`` is given."""
    pairs = features.exploded(candidates)
    rows = matcher.scored(model, features.features(pairs, normalised))
    found = matcher.matches(rows, threshold, owner_exclusive)
    if out_dir:
        sinks.write_results(candidates, found, pairs, out_dir)
    return found
