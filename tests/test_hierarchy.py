"""Per-class report and multi-label averages against direct computations."""

import math
import random

from tabkiln.operators import hierarchy, metrics


def _sig(x):
    return 1.0 / (1.0 + math.exp(-x))


def _rows():
    rnd = random.Random(7)
    rows = []
    for i in range(60):
        for lab in range(4):
            logit = rnd.uniform(-3, 3)
            if lab == 0:
                y = 0  # single-class truth: counts forced to 0
            elif lab == 1:
                y = 1 if logit > 0 else 0
            elif lab == 2:
                y = rnd.randint(0, 1)
                logit = -5.0  # every prediction negative: no grid point qualifies
            else:
                y = rnd.randint(0, 1)
            rows.append((i, 1, "main", lab, f"Main_{lab}", logit, y))
    return rows


def test_per_class_report_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, level int, kind string, label_idx int, label_name string, logit double, y int")
    got = {r["label_idx"]: r for r in hierarchy.per_class_report(df).collect()}
    for lab in range(4):
        sub = [(_sig(lg), y) for (_, _, _, l, _, lg, y) in rows if l == lab]
        best_t, best_f1 = 0.5, 0.0
        for t in metrics.LABEL_GRID:
            pred = [1 if p >= t else 0 for p, _ in sub]
            if len(set(pred)) > 1 and len({y for _, y in sub}) > 1:
                tp = sum(1 for q, (_, y) in zip(pred, sub) if q and y)
                fp = sum(1 for q, (_, y) in zip(pred, sub) if q and not y)
                fn = sum(1 for q, (_, y) in zip(pred, sub) if not q and y)
                f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
                if f1 > best_f1:
                    best_t, best_f1 = t, f1
        assert got[lab]["optimal_threshold"] == best_t
        pred = [1 if p >= best_t else 0 for p, _ in sub]
        if len({y for _, y in sub}) > 1:
            tp = sum(1 for q, (_, y) in zip(pred, sub) if q and y)
            tn = sum(1 for q, (_, y) in zip(pred, sub) if not q and not y)
        else:
            tp = tn = 0
        assert (got[lab]["tp"], got[lab]["tn"]) == (tp, tn)


def test_exact_match_accuracy(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, level int, kind string, label_idx int, label_name string, logit double, y int")
    r = hierarchy.multilabel_metrics(df).first()
    per_id = {}
    for i, _, _, _, _, lg, y in rows:
        per_id.setdefault(i, True)
        per_id[i] = per_id[i] and ((1 if _sig(lg) >= 0.5 else 0) == y)
    assert abs(r["accuracy"] - sum(per_id.values()) / len(per_id)) < 1e-12


def test_default_loss_weights_follow_every_level(spark):
    rows = [("a", level, kind, 0, "x", 0.3, 1) for level in (1, 2, 3) for kind in ("main", "sub")]
    df = spark.createDataFrame(rows, "id string, level int, kind string, label_idx int, label_name string, logit double, y int")
    got = {(r["level"], r["kind"]): round(r["weight"], 6) for r in hierarchy.hierarchical_bce(df).collect()}
    assert got == {k: round(v, 6) for k, v in hierarchy.default_loss_weights([1, 2, 3]).items()}
    assert (got[3, "main"], got[3, "sub"]) == (1.2, 0.96)
