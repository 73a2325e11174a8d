"""Second-order trees: the first tree of every head against SQL, and all heads' full models."""

from __future__ import annotations

from ..operators import boosting as B
from ..operators.evaluate import HEADS
from ..sources import sinks as K
from .evaluation import SCORED
from .registry import add
from .training import ALL, FEATURES, REGRESSION, rows

KINDS = {h: ("regression" if h in REGRESSION else "classification", f"target_{h}") for h in ALL}
KEY = ("code", "date")
#: One tree of two levels over all rows and columns, so that SQL can follow it.
SHORT = B.Boost(depth=2, trees=1, sample=1.0, columns=1.0, bins=16)


def boosted_splits(s, d):
    df = K.stored(rows(s, d), "training")
    model = B.fit(df, FEATURES, B.heads_for(df, KINDS), KEY, SHORT)
    return B.splits(s, model).drop("tree")


def _level(name: str, of: str) -> str:
    """Best splits of the nodes in table of (rid, head, node, g, h), as CTE name."""
    score = "2 * {g} * {w} + ({h} + 1) * {w} * {w}"
    worth = lambda g, h: f"-({score.format(g=g, h=h, w=f'CASE WHEN classes THEN least(greatest(-{g} / ({h} + 1), -1), 1) ELSE -{g} / ({h} + 1) END')})"
    return f"""{name}_h AS (SELECT head, node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {of} JOIN binned USING (rid) GROUP BY ALL),
{name}_t AS (SELECT head, node, feature, sum(g) AS g, sum(h) AS h, sum(n) AS n, coalesce(sum(g) FILTER (bin = 255), 0) AS mg, coalesce(sum(h) FILTER (bin = 255), 0) AS mh, coalesce(sum(n) FILTER (bin = 255), 0) AS mn FROM {name}_h GROUP BY ALL),
{name}_b AS (SELECT t.*, k, coalesce((SELECT sum(x.g) FROM {name}_h x WHERE x.head = t.head AND x.node = t.node AND x.feature = t.feature AND x.bin <= k), 0) AS kg,
    coalesce((SELECT sum(x.h) FROM {name}_h x WHERE x.head = t.head AND x.node = t.node AND x.feature = t.feature AND x.bin <= k), 0) AS kh FROM {name}_t t, (SELECT unnest(generate_series(0, {SHORT.bins - 1})) AS k)),
{name}_d AS (SELECT *, kg + mg AS lg, kh + mh AS lh, true AS missing_left FROM {name}_b UNION ALL SELECT *, kg, kh, false FROM {name}_b WHERE mn > 0),
{name}_r AS (SELECT head, node, feature, k, missing_left, n, classes, lg / {B.UNITS}::DOUBLE * spread AS lg, lh / {B.UNITS}::DOUBLE * hs AS lh, g / {B.UNITS}::DOUBLE * spread AS tg, h / {B.UNITS}::DOUBLE * hs AS th FROM {name}_d JOIN heads USING (head)),
{name}_g AS (SELECT *, {worth('lg', 'lh')} + {worth('(tg - lg)', '(th - lh)')} - ({worth('tg', 'th')}) AS gain FROM {name}_r WHERE lh >= 1 AND th - lh >= 1),
{name} AS (SELECT head, node, feature, k, missing_left, n, gain FROM {name}_g WHERE gain > 0.000001 QUALIFY row_number() OVER (PARTITION BY head, node ORDER BY round(gain, 9) DESC, feature, missing_left DESC, k) = 1)"""


_B = SHORT.bins
SQL = f"""WITH {SCORED}, numbered AS (SELECT *, row_number() OVER (ORDER BY code, date) AS rid FROM scored),
cells AS ({' UNION ALL '.join(f"SELECT rid, {k} AS feature, CAST({c} AS DOUBLE) AS x FROM numbered" for k, c in enumerate(('grid_step_pct', *(f'pred_{h}' for h in ALL[:3]))))}),
counted AS (SELECT feature, x, count(*) AS n FROM cells WHERE x IS NOT NULL GROUP BY ALL),
placed AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY x) - n AS below, sum(n) OVER (PARTITION BY feature) AS total FROM counted),
cuts AS (SELECT feature, x AS cut, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS place FROM placed WHERE least(floor((below + n) * {_B} / total), {_B - 1}) > floor(below * {_B} / total)),
binned AS (SELECT rid, feature, CASE WHEN x IS NULL THEN 255 ELSE (SELECT count(*) FROM cuts WHERE cuts.feature = cells.feature AND cuts.cut < cells.x) END AS bin FROM cells),
ys AS ({' UNION ALL '.join(f"SELECT rid, '{h}' AS head, {str(k == 'classification').lower()} AS classes, CAST({t} AS DOUBLE) AS y FROM numbered WHERE {t} IS NOT NULL" for h, (k, t) in KINDS.items())}),
stats AS (SELECT head, classes, round(avg(y), 9) AS mean, min(y) AS lo, max(y) AS hi, sum(y) AS pos, count(*) AS n FROM ys GROUP BY ALL),
weights AS (SELECT *, CASE WHEN classes THEN greatest(1.0::DOUBLE, (n - pos) / pos) ELSE 1.0::DOUBLE END AS weight FROM stats),
heads AS (SELECT head, classes, weight, CASE WHEN classes THEN weight ELSE greatest(hi - mean, mean - lo) END AS spread, CASE WHEN classes THEN weight ELSE 1.0::DOUBLE END AS hs,
    CASE WHEN classes THEN pos * weight / (pos * weight + n - pos) ELSE mean END AS start FROM weights),
grads AS (SELECT rid, head, 0 AS node, CAST(round(CASE WHEN classes THEN (start - y) * CASE WHEN y = 1 THEN weight ELSE 1 END ELSE start - y END / spread * {B.UNITS}::DOUBLE) AS BIGINT) AS g,
    CAST(round(CASE WHEN classes THEN start * (1 - start) * CASE WHEN y = 1 THEN weight ELSE 1 END ELSE 1 END / hs * {B.UNITS}::DOUBLE) AS BIGINT) AS h FROM (SELECT rid, head, y FROM ys) JOIN heads USING (head)),
{_level('root', 'grads')},
below_root AS (SELECT q.rid, q.head, CASE WHEN CASE WHEN bin = 255 THEN missing_left ELSE bin <= k END THEN 1 ELSE 2 END AS node, q.g, q.h
    FROM grads q JOIN root ON root.head = q.head JOIN binned b ON b.rid = q.rid AND b.feature = root.feature),
{_level('next_', 'below_root')},
chosen AS (SELECT * FROM root UNION ALL SELECT * FROM next_)
SELECT head, CAST(node AS INTEGER) AS node, CASE feature {' '.join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(FEATURES))} END AS feature, cut, missing_left, gain, CAST(n AS BIGINT) AS n
FROM chosen LEFT JOIN (SELECT feature, place, cut FROM cuts) c USING (feature) WHERE c.place = k"""
add("boosted_splits", boosted_splits, SQL, "cut gain")
