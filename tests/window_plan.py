"""The dashboard written literally with window functions: every kept row goes
through one task for the medians, so this is a check on small data only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.operators import dashboard as dash


def window_dashboard(tables):
    base = dash.trip_base(tables)
    cols = []
    for keys, aggs in dash.GROUP_METRICS:
        w = Window.partitionBy(*keys)
        cols += [dash._agg(kind, c).over(w).alias(name) for name, kind, c in aggs]
    everything = Window.partitionBy()
    cols += [F.percentile(col, 0.5).over(everything).alias(name) for name, col in dash.MEDIANS]
    return dash.labels(base.select("*", *cols)).select(*dash.DASHBOARD_COLUMNS)
