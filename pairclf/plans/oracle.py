"""The registered queries as SQL for DuckDB, on the same tables.

Training is a recursive query: one step per iteration with the same update and
stop rule, from which the iteration limits of the grid are read.
"""

from __future__ import annotations

from ..functions.fixed_values import (
    ITERATIONS,
    LISTED_COLUMN,
    LISTED_IMAGES,
    PAIR_TRAIN_PERCENT,
    REG_PARAMS,
    REST_TRAIN_PERCENT,
    SECOND_SOURCE_TRAIN_PERCENT,
    STEP_SIZES,
    SWEEP_TRAIN_PERCENTS,
    TOLERANCE,
)

_NAME = "chr((97 + label)::int)"


def _source(name: str, number: str, ending: str = "'.jpg.json'") -> str:
    return f"""{name} AS (
  SELECT *, (('0x' || substr(md5(images), 1, 8))::bigint % 100)::int AS bucket
  FROM (SELECT {_NAME} AS label, {_NAME} || '_' || vec_id || {ending} AS images,
               list_transform(embedding, lambda v: {number}) AS features
        FROM embeddings))"""


FEATS = _source("feats", "v::double * 10")
SECOND = _source(
    "second", "floor(v::double * 10)", "CASE WHEN vec_id % 4 = 3 THEN '_2.jpg.json' ELSE '.jpg.json' END"
)

PAIRS = """pairs AS (
  SELECT a.label AS class1, b.label AS class2
  FROM (SELECT DISTINCT label FROM feats) a JOIN (SELECT DISTINCT label FROM feats) b ON a.label < b.label)"""


def _tasks(pair_cuts, rest_cuts) -> str:
    return f"""{PAIRS},
tasks AS (
  SELECT kind, class1, class2, cut, cut / 100.0::double AS train_fraction, class1 || '_vs._' || class2 AS task
  FROM (SELECT '1vs1' AS kind, class1, class2, unnest({list(pair_cuts)}::int[]) AS cut FROM pairs
        UNION ALL
        SELECT '1vsAll', label, 'All', unnest({list(rest_cuts)}::int[]) FROM (SELECT DISTINCT label FROM feats)))"""


_MEMBERS = """members AS (
  SELECT t.*, f.label, f.images, f.features, f.bucket,
         CASE WHEN kind = '1vs1' OR f.label = class1 THEN f.label ELSE 'All' END AS task_label
  FROM tasks t JOIN feats f ON t.kind = '1vsAll' OR f.label IN (t.class1, t.class2))"""

_INDEXED = """indexed AS (
  SELECT *, (row_number() OVER (PARTITION BY kind, class1, class2, cut ORDER BY n_train DESC, task_label) - 1)::double
           AS label_index
  FROM (SELECT kind, class1, class2, cut, train_fraction, task_label, count(*) AS n_train
        FROM members WHERE bucket < cut GROUP BY ALL))"""

_KEY = "kind, class1, class2, train_fraction, cut"


def _training(limits) -> str:
    step, reg = STEP_SIZES[0], REG_PARAMS[0]
    return f"""runs AS (
  SELECT {_KEY}, sum(n_train)::double AS n FROM indexed GROUP BY ALL HAVING count(*) = 2),
train AS MATERIALIZED (
  SELECT m.kind, m.class1, m.class2, m.train_fraction, m.cut, m.features, 2 * i.label_index - 1 AS s
  FROM members m JOIN indexed i USING (kind, class1, class2, cut, task_label) WHERE m.bucket < m.cut),
descent AS (
  SELECT {_KEY}, n, 0 AS i, (SELECT list_transform(any_value(features), lambda v: 0.0::double) FROM feats) AS w,
         false AS stopped
  FROM runs
  UNION ALL
  SELECT {_KEY}, n, i, CASE WHEN stopped THEN w ELSE moved END,
         stopped OR (i > 1 AND list_distance(moved, w)
                     < {TOLERANCE} * greatest(sqrt(list_dot_product(moved, moved)), 1.0))
  FROM (
    SELECT {_KEY}, n, i, any_value(w) AS w, stopped,
           list(w[k] * (1 - {step} / sqrt(i) * {reg}) + {step} / sqrt(i) / n * coalesce(
                  list_dot_product(signs, list_transform(active, lambda x: x[k])), 0) ORDER BY k) AS moved
    FROM (
      SELECT {_KEY}, n, i, w, stopped, signs, active, unnest(generate_series(1, len(w))) AS k
      FROM (
        SELECT {_KEY}, n, i, stopped, any_value(w) AS w,
               list(s) FILTER (is_active) AS signs, list(features) FILTER (is_active) AS active
        FROM (
          SELECT d.kind, d.class1, d.class2, d.train_fraction, d.cut, d.n, d.i + 1 AS i, d.w, d.stopped, t.s,
                 t.features, NOT d.stopped AND t.s * list_dot_product(t.features, d.w) < 1 AS is_active
          FROM descent d JOIN train t USING (kind, class1, class2, cut) WHERE d.i < {max(limits)})
        GROUP BY {_KEY}, n, i, stopped))
    GROUP BY {_KEY}, n, i, stopped)),
models AS MATERIALIZED (
  SELECT {_KEY}, list_position({list(limits)}, i)::int AS model_number, i::int AS "numIter", {step}::double AS "stepSize",
         {reg}::double AS "regParam", w
  FROM descent WHERE i IN {tuple(limits)})"""


_PREDICTED = """predicted AS (
  SELECT m.*, 'test' AS eval_set, r.images, i.label_index,
         (list_dot_product(r.features, m.w) > 0)::int AS label_index_predicted
  FROM models m
  JOIN members r USING (kind, class1, class2, cut)
  JOIN indexed i USING (kind, class1, class2, cut, task_label)
  WHERE r.bucket >= m.cut)"""


def _predicted_all(own_cut: int | None) -> str:
    own = "" if own_cut is None else f" OR r.bucket >= {own_cut} AND r.images NOT IN (SELECT images FROM feats)"
    return f"""predicted_all AS (
  SELECT m.*, 'all' AS eval_set, r.images, i.label_index,
         (list_dot_product(r.features, m.w) > 0)::int AS label_index_predicted
  FROM models m
  JOIN second r ON (r.bucket >= m.cut{own})
  JOIN indexed i ON i.kind = m.kind AND i.class1 = m.class1 AND i.class2 = m.class2 AND i.cut = m.cut
       AND i.task_label = CASE WHEN r.label = m.class1 THEN m.class1 ELSE 'All' END
  WHERE m.kind = '1vsAll')"""


_METRICS = """metrics AS MATERIALIZED (
  SELECT *, hits / total AS accuracy, errors / total AS error_rate
  FROM (SELECT kind, class1, class2, train_fraction, model_number, "numIter", "stepSize", "regParam", eval_set,
               (count(*) FILTER (label_index_predicted = label_index))::bigint AS hits,
               (count(*) FILTER (label_index_predicted <> label_index))::bigint AS errors,
               count(*)::bigint AS total
        FROM (SELECT * FROM predicted UNION ALL BY NAME SELECT * FROM predicted_all) GROUP BY ALL))"""

_BEST = """best AS (
  SELECT kind, class1, class2, train_fraction, class1 || '_vs._' || class2 AS task,
         CASE WHEN accuracy > 0 THEN model_number END AS model_number,
         CASE WHEN accuracy > 0 THEN "numIter" END AS "numIter",
         CASE WHEN accuracy > 0 THEN "stepSize" END AS "stepSize",
         CASE WHEN accuracy > 0 THEN "regParam" END AS "regParam",
         hits, errors, total, accuracy, error_rate
  FROM metrics WHERE eval_set = 'test'
  QUALIFY row_number() OVER (PARTITION BY kind, class1, class2, train_fraction
                             ORDER BY accuracy DESC NULLS LAST, model_number) = 1)"""


def _run(pair_cuts, rest_cuts, own_cut: int | None, *more: str) -> str:
    parts = [FEATS, SECOND, _tasks(pair_cuts, rest_cuts), _MEMBERS, _INDEXED, _training(ITERATIONS),
             _PREDICTED, _predicted_all(own_cut), _METRICS, *more]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


_STANDARD = ([PAIR_TRAIN_PERCENT], [REST_TRAIN_PERCENT], SECOND_SOURCE_TRAIN_PERCENT)
_SWEEP = (SWEEP_TRAIN_PERCENTS, SWEEP_TRAIN_PERCENTS, None)
_ALL_CUTS = (SWEEP_TRAIN_PERCENTS, [*SWEEP_TRAIN_PERCENTS, REST_TRAIN_PERCENT])

_TASK = "kind, class1, class2, train_fraction"
_SHOWN = f"""{_TASK}, model_number, "numIter", eval_set, hits, errors, total,
  round(accuracy, 6) AS accuracy, round(error_rate, 6) AS error_rate"""
_SHOWN_SET = _SHOWN.replace("eval_set, ", "")
_SHOWN_BEST = f"""{_TASK}, task, model_number, "numIter", "stepSize", "regParam", hits, errors, total,
  round(accuracy, 6) AS accuracy, round(error_rate, 6) AS error_rate"""
_PARAMETERS = """printf('%.2f', "numIter"::double), printf('%.2f', "stepSize"), printf('%.2f', "regParam")"""
_QUALITY = "printf('%.3f', accuracy), errors, printf('%.3f', error_rate)"


def _tasks_only(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([FEATS, _tasks(*_ALL_CUTS), *more]) + "\n" + select


ORACLE: dict[str, str] = {
    "feature_scan": f"""WITH {FEATS},
odd AS (
  SELECT CASE regexp_extract(images, '([0-9]+)', 1)::int % 40 WHEN 1 THEN '_' WHEN 2 THEN '.'
         WHEN 3 THEN 'great dane%20+é' ELSE '' END || images AS images, features FROM feats),
letters AS (SELECT *, regexp_replace(images, '[0-9]', '', 'g') AS l FROM odd)
SELECT images, trim(left(l, greatest(length(l) - 9, 0)), '_') AS label, len(features)::int AS n_features,
       features[1] AS first_number, features[-1] AS last_number FROM letters""",
    "feature_table": f"WITH {FEATS} SELECT images, label, len(features)::int AS n_features FROM feats",
    "two_source_union": f"""WITH {FEATS}, {SECOND}
SELECT source, label, count(*)::bigint AS n
FROM (SELECT 'main' AS source, label FROM feats UNION ALL SELECT 'all', label FROM second) GROUP BY ALL""",
    "label_parse": f"""WITH {FEATS},
letters AS (SELECT images, regexp_replace(images, '[0-9]', '', 'g') AS l FROM feats)
SELECT images, trim(left(l, greatest(length(l) - 9, 0)), '_') AS label FROM letters""",
    "vector_parse": f"""WITH {FEATS}
SELECT images, (k - 1)::int AS k, v::varchar::double AS v
FROM (SELECT images, unnest(features) AS v, generate_subscripts(features, 1) AS k FROM feats)""",
    "class_list": f"WITH {FEATS} SELECT DISTINCT label FROM feats ORDER BY label",
    "class_pairs": f"WITH {FEATS}, {PAIRS} SELECT class1, class2 FROM pairs",
    "ova_tasks": f"WITH {FEATS} SELECT DISTINCT label AS class1, 'All' AS class2 FROM feats",
    "grid_points": "WITH " + FEATS + ",\n" + _tasks(*_STANDARD[:2]) + f"""
SELECT kind, class1, class2, list_position({ITERATIONS}, i)::int AS model_number, i::int AS "numIter",
       {STEP_SIZES[0]}::double AS "stepSize", {REG_PARAMS[0]}::double AS "regParam"
FROM (SELECT *, unnest({ITERATIONS}) AS i FROM tasks)""",
    "task_keys": _tasks_only(f"""SELECT {_TASK}, task,
  train_fraction::varchar || '_Obs_' || class1 || '_vs_' || class2 || '.png' AS curve FROM tasks"""),
    "pair_filter": f"""WITH {FEATS}, {PAIRS}
SELECT class1, class2, label, count(*)::bigint AS n
FROM pairs JOIN feats ON label = class1 OR label = class2 GROUP BY ALL""",
    "pair_filter_rows": f"WITH {FEATS} SELECT images, label FROM feats WHERE label IN ('a', 'b')",
    "ova_relabel_rows": f"""WITH {FEATS}
SELECT images, CASE WHEN label = 'a' THEN label ELSE 'All' END AS label FROM feats""",
    "ova_relabel": f"""WITH {FEATS}
SELECT c.class1, CASE WHEN f.label = c.class1 THEN f.label ELSE 'All' END AS label, count(*)::bigint AS n
FROM (SELECT DISTINCT label AS class1 FROM feats) c CROSS JOIN feats f GROUP BY ALL""",
    "split_counts": _tasks_only(f"""SELECT {_TASK}, bucket >= cut AS is_test, count(*)::bigint AS n
FROM members GROUP BY ALL""", _MEMBERS),
    "label_index": _tasks_only(f"""SELECT {_TASK}, task_label AS label, n_train::bigint AS n_train, label_index
FROM indexed""", _MEMBERS, _INDEXED),
    "image_index": "WITH " + ",\n".join([FEATS, _tasks([PAIR_TRAIN_PERCENT], []), _MEMBERS]) + """
SELECT class1, class2, train_fraction, images,
       (row_number() OVER (PARTITION BY class1, class2, train_fraction ORDER BY count(*) DESC, images) - 1)::double
         AS images_index
FROM members WHERE bucket >= cut GROUP BY class1, class2, train_fraction, images""",
    "image_index_rest": f"""WITH {FEATS},
shares AS (SELECT unnest({[*SWEEP_TRAIN_PERCENTS, REST_TRAIN_PERCENT]}) AS cut)
SELECT cut / 100.0::double AS train_fraction, images,
       (row_number() OVER (PARTITION BY cut ORDER BY count(*) DESC, images) - 1)::double AS images_index
FROM feats JOIN shares ON bucket >= cut GROUP BY cut, images""",
    "index_sample": """WITH numbered AS (
  SELECT event_type, (row_number() OVER (ORDER BY count(*) DESC, event_type) - 1)::double AS n
  FROM events GROUP BY event_type)
SELECT event_id AS id, event_type AS category, n AS "categoryIndex" FROM events JOIN numbered USING (event_type)""",
    "svm_weights": _run(*_STANDARD) + f"""SELECT {_TASK}, "numIter", k::int AS k, round(v, 6) AS w
FROM (SELECT {_TASK}, "numIter", unnest(w) AS v, generate_subscripts(w, 1) AS k FROM models)""",
    "predictions_ovo": _run(*_STANDARD) + f"""SELECT {_TASK}, "numIter", images, label_index, label_index_predicted
FROM predicted WHERE kind = '1vs1'""",
    "predictions_ova": _run(*_STANDARD) + f"""SELECT {_TASK}, "numIter", images, label_index, label_index_predicted
FROM predicted WHERE kind = '1vsAll'""",
    "hits_ovo": _run(*_STANDARD) + f"""SELECT {_TASK}, "numIter", count(*)::bigint AS hits FROM predicted
WHERE kind = '1vs1' AND label_index_predicted = label_index GROUP BY ALL""",
    "accuracy_ovo": _run(*_STANDARD) + f"SELECT {_SHOWN_SET} FROM metrics WHERE kind = '1vs1'",
    "accuracy_ova": _run(*_STANDARD) + f"SELECT {_SHOWN_SET} FROM metrics WHERE kind = '1vsAll' AND eval_set = 'test'",
    "accuracy_ova_all": _run(*_STANDARD) + f"SELECT {_SHOWN_SET} FROM metrics WHERE eval_set = 'all'",
    "grid_accuracy": _run(*_STANDARD) + f"SELECT {_SHOWN} FROM metrics",
    "sweep_accuracy": _run(*_SWEEP) + f"SELECT {_SHOWN} FROM metrics",
    "curve_iterations": _run(*_SWEEP) + f"""SELECT {_TASK},
  train_fraction::varchar || '_Obs_' || class1 || '_vs_' || class2 || '.png' AS curve,
  eval_set, "numIter", round(accuracy, 6) AS accuracy FROM metrics""",
    "best_model": _run(*_STANDARD, _BEST) + f"SELECT {_SHOWN_BEST} FROM best",
    "best_model_last_fraction": _run(*_SWEEP, _BEST) + f"""SELECT {_SHOWN_BEST} FROM best
QUALIFY row_number() OVER (PARTITION BY kind, class1, class2 ORDER BY train_fraction DESC) = 1""",
    "best_models_json": _run(*_STANDARD, _BEST) + """SELECT task,
  to_json({'Accuracy': accuracy, 'numIter': "numIter", 'stepSize': "stepSize", 'regParam': "regParam"})::varchar
    AS record FROM best""",
    "model_report": _run(*_STANDARD) + f"""SELECT {_TASK}, model_number, eval_set,
  printf('|%s #%d' || chr(10) || '|%s trained with (numIter: %s, stepSize = %s, regParam = %s)' || chr(10)
         || '|%s has accuracy of %s (errors: %d / training error: %s) on test',
         t, model_number, t, {_PARAMETERS}, t, {_QUALITY}) AS report
FROM (SELECT *, CASE WHEN eval_set = 'all' THEN 'Model_All' ELSE 'Model' END AS t FROM metrics)""",
    "best_model_report": _run(*_STANDARD, _BEST) + f"""SELECT {_TASK}, task,
  printf('|Model #%d is the best model' || chr(10)
         || '|The best model was trained with (numIter: %s, stepSize = %s, regParam = %s)' || chr(10)
         || '|The best model has accuracy of %s (errors: %d / training error: %s) on test',
         model_number, {_PARAMETERS}, {_QUALITY}) AS report FROM best""",
    "curve_fraction": _run(*_SWEEP, _BEST) + """SELECT kind, class1, class2, task, train_fraction,
  round(accuracy, 6) AS accuracy FROM best""",
    "misclassified": _run(*_STANDARD) + f"""SELECT {_TASK}, "numIter", "stepSize", "regParam",
  images AS "{LISTED_COLUMN}" FROM predicted WHERE label_index_predicted <> label_index
QUALIFY row_number() OVER (PARTITION BY {_TASK}, "numIter" ORDER BY images) <= {LISTED_IMAGES}""",
    "misclassified_counts": _run(*_SWEEP) + """SELECT images, count(*)::bigint AS errors
FROM predicted WHERE label_index_predicted <> label_index GROUP BY images""",
    "misclassified_all": _run(*_STANDARD) + f"""SELECT {_TASK}, "numIter", images, label_index, label_index_predicted
FROM predicted_all WHERE label_index_predicted <> label_index""",
    "misclassified_by_vector": _run(*_STANDARD, """vectors AS (
  SELECT p.*, r.features FROM predicted p JOIN members r USING (kind, class1, class2, cut, images)
  WHERE label_index_predicted <> label_index),
chain AS (
  SELECT e.kind, e.class1, e.class2, e.train_fraction, e."numIter", e."stepSize", e."regParam", b.images,
         count(*)::bigint AS times_listed
  FROM vectors e
  JOIN members a ON a.kind = e.kind AND a.class1 = e.class1 AND a.class2 = e.class2 AND a.cut = e.cut
       AND a.bucket >= a.cut AND a.features = e.features
  JOIN members b ON b.kind = a.kind AND b.class1 = a.class1 AND b.class2 = a.class2 AND b.cut = a.cut
       AND b.bucket >= b.cut AND b.images = a.images
  GROUP BY ALL)""") + f"""SELECT {_TASK}, "numIter", "stepSize", "regParam", images AS "{LISTED_COLUMN}", times_listed
FROM chain QUALIFY row_number() OVER (PARTITION BY {_TASK}, "numIter" ORDER BY images) <= {LISTED_IMAGES}""",
    "word_totals": """SELECT event_type AS word, sum(user_id)::bigint AS total,
  event_type || chr(9) || sum(user_id)::bigint || ' occurences' AS line FROM events GROUP BY event_type""",
    "word_run_totals": """WITH starts AS (
  SELECT event_id, event_type, user_id,
         CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY event_id) THEN 1 ELSE 0 END AS s
  FROM events),
runs AS (SELECT *, sum(s) OVER (ORDER BY event_id) AS run FROM starts)
SELECT run::bigint AS run, event_type AS word, sum(user_id)::bigint AS total,
       event_type || chr(9) || sum(user_id)::bigint || ' occurences' AS line
FROM runs GROUP BY run, event_type""",
}
ORACLE["best_models_object"] = ORACLE["best_models_json"]
ORACLE["word_totals_stream"] = ORACLE["word_totals"]
