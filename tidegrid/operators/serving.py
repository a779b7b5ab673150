"""Summary tables for an operations team."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import labels
from tidegrid.functions.times import cyclical
from tidegrid.operators.ranking import selected, value_ranges
from tidegrid.sources.scratch import saved

CAPACITY = 20
HIGH_DEMAND = 3.0


def clipped(prediction: Column) -> Column:
    """P14."""
    return F.round(F.greatest(prediction, F.lit(0.0)), 4)


def json_safe(df: DataFrame) -> DataFrame:
    """Floats without NaN or infinity, at six places; times as ISO text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("double", "float"):
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.round(c, 6))
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(name))
    return df.select(*out)


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """A26."""
    p = F.col("predicted_demand")
    return predictions.groupBy("station_id").agg(F.round(F.avg(p), 4).alias("mean_demand"), F.max(p).alias("max_demand"), F.round(F.sum(p), 4).alias("total_demand"), F.min("forecast_hour").alias("first_hour"), F.min_by("model_version", "forecast_hour").alias("model_version"))


def network_demand(predictions: DataFrame) -> DataFrame:
    """A27."""
    return predictions.groupBy(F.hour("forecast_hour").alias("hour_of_day")).agg(F.round(F.sum("predicted_demand"), 4).alias("total_demand"), F.min("forecast_hour").alias("first_hour"))


def station_peaks(predictions: DataFrame, high: float = HIGH_DEMAND) -> DataFrame:
    """A28, P23, P24."""
    peak = F.max("predicted_demand")
    out = predictions.groupBy("station_id").agg(peak.alias("peak_demand"))
    p = F.col("peak_demand")
    return out.withColumns({"tier": labels.demand_tier(p), "action": labels.demand_action(p), "recommended_stock": labels.recommended_stock(p), "high_demand": p >= high})


def forecast_summary(predictions: DataFrame) -> DataFrame:
    """A29, of each station: its peak, its average, and the first hour of its peak."""
    p = F.col("predicted_demand")
    first = F.max_by("forecast_hour", F.struct(p, -F.unix_seconds(F.col("forecast_hour").cast("timestamp"))))
    return predictions.groupBy("station_id").agg(F.max(p).alias("peak"), F.round(F.avg(p), 6).alias("average"), first.alias("peak_hour"))


def demand_heatmap(panel: DataFrame) -> DataFrame:
    """Mean demand, a row a weekday, a column an hour. The values are named, so no job looks for them."""
    wide = panel.groupBy("day_of_week").pivot("hour_of_day", list(range(24))).agg(F.round(F.avg("demand_count"), 6))
    return wide.select("day_of_week", *(F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)))


def hourly_profile(panel: DataFrame, top: int | None = None) -> DataFrame:
    """A31; with ``top``, the busiest hours."""
    out = panel.groupBy("hour_of_day").agg(F.round(F.avg("demand_count"), 6).alias("mean_demand"), F.sum("demand_count").alias("total_demand"))
    return out if top is None else out.orderBy(F.desc("mean_demand"), "hour_of_day").limit(top)


def station_risk(predictions: DataFrame, stations: DataFrame, default: int = CAPACITY) -> DataFrame:
    """Risk by a station's mean among the stations' means, whose thresholds are elements of the sorted list, not
    interpolations. They are selected from ranges of the list; predictions are aggregated first, and once."""
    means = saved(predictions.groupBy("station_id").agg(F.avg("predicted_demand").alias("mean"), F.sum("predicted_demand").alias("_s"), F.count("*").alias("_c")), "station-means")
    element = lambda q: F.floor(F.col("_all") * F.lit(q))
    marks = selected(value_ranges(means, F.col("mean")), {"p85": element(0.85), "p65": element(0.65), "p15": element(0.15)})
    marks = marks.crossJoin(means.agg((F.sum("_s") / F.sum("_c")).alias("network")))
    mean, network = F.col("mean"), F.when(F.col("network") != 0, F.col("network")).otherwise(F.lit(1.0))
    out = means.join(stations.select("station_id", "capacity"), "station_id", "left").crossJoin(F.broadcast(marks))
    risk = F.when(mean >= F.col("p85"), "critical").when(mean >= F.col("p65"), "low").when(mean <= F.col("p15"), "surplus").otherwise("moderate")
    out = out.withColumns({"capacity": F.coalesce("capacity", F.lit(default)).cast("int"), "fill_pct": F.least(F.lit(95), F.greatest(F.lit(5), F.floor(80 - mean / network * 35 + 0.5))).cast("int"), "risk_level": risk})
    bikes = F.floor(F.col("fill_pct") * F.col("capacity") / 100.0 + 0.5).cast("int")
    flow = F.when(F.col("risk_level") == "critical", -F.ceil("mean")).when(F.col("risk_level") == "surplus", F.ceil(F.col("mean") * 0.5)).otherwise(F.lit(0))
    return out.withColumns({"current_bikes": bikes, "net_flow_1h": flow.cast("int")}).select("station_id", "capacity", "fill_pct", "current_bikes", F.round("mean", 4).alias("mean_demand"), "risk_level", "net_flow_1h")


def fill_table(status: DataFrame) -> DataFrame:
    """P21, P22, P28 over (station_id, fill_pct)."""
    pct, share = F.col("fill_pct"), F.col("fill_pct") / 100.0
    return status.select("station_id", "fill_pct", labels.urgency(share).alias("urgency"), labels.action(share).alias("action"), labels.risk(pct).alias("risk"), labels.fill_severity(pct, "bar").alias("bar_severity"), labels.fill_severity(pct, "map").alias("map_severity"))


def alert_counts(fills: DataFrame) -> DataFrame:
    """All levels, those without stations too."""
    levels = fills.sparkSession.createDataFrame([("Critical",), ("Warning",), ("OK",)], "urgency string")
    return levels.join(fills.groupBy("urgency").agg(F.count("*").alias("n")), "urgency", "left").na.fill(0, ["n"])


def network_kpis(fills: DataFrame) -> DataFrame:
    """A33."""
    pct = F.col("fill_pct")
    risks = [F.count_if(F.col("risk") == r).alias(f"n_{r}") for r in ("critical", "low", "surplus", "moderate")]
    return fills.agg(F.round(100.0 * F.count_if(F.col("risk") == "moderate") / F.count("*"), 4).alias("healthy_pct"), F.round(F.avg(pct), 4).alias("average_fill"), F.count_if(pct <= 10).alias("need_bikes"), F.count_if(pct >= 90).alias("overflow"), *risks)


def top_alerts(fills: DataFrame, demand: DataFrame, top: int = 20) -> DataFrame:
    """T02."""
    own = fills.where(F.col("urgency").isin("Critical", "Warning")).join(demand, "station_id")
    return own.orderBy("urgency", F.desc("mean_demand"), "station_id").limit(top).select("station_id", "urgency", "mean_demand")


def alert_filter(fills: DataFrame, levels: tuple[str, ...], districts: tuple[str, ...] | None = None) -> DataFrame:
    """P17."""
    out = fills.where(F.col("urgency").isin(*levels))
    return out if districts is None else out.where(F.col("district").isin(*districts))


def priority_list(fills: DataFrame, top: int = 14) -> DataFrame:
    """T03."""
    rank = F.when(F.col("risk") == "critical", 0).when(F.col("risk") == "surplus", 1).when(F.col("risk") == "low", 2).otherwise(3)
    return fills.withColumn("risk_rank", rank).orderBy("risk_rank", "fill_pct", "station_id").limit(top).select("station_id", "risk", "fill_pct", "risk_rank")


def top_features(importance: DataFrame, top: int = 15) -> DataFrame:
    """T04."""
    return importance.orderBy(F.desc("importance"), "feature").limit(top)


def score_agreement(importance: DataFrame, top: int = 3) -> DataFrame:
    """Whether two scores (gain, shap) have the same best features."""
    best = lambda c, name: importance.orderBy(F.desc(c), "feature").limit(top).agg(F.array_sort(F.collect_list("feature")).alias(name))
    return best("gain", "g").crossJoin(best("shap", "s")).select(F.array_join("g", ",").alias("top_gain"), F.array_join("s", ",").alias("top_shap"), (F.col("g") == F.col("s")).alias("agree"))


def category_share(importance: DataFrame, categories: DataFrame) -> DataFrame:
    """A36."""
    by = importance.join(F.broadcast(categories), "feature").groupBy("category").agg(F.sum("importance").alias("_s"))
    return by.select("category", F.round("_s", 6).alias("importance"), F.round(100.0 * F.col("_s") / F.sum("_s").over(Window.partitionBy(F.lit(1))), 4).alias("share_pct"))


def top_stations(stations: DataFrame, top: int = 10) -> DataFrame:
    """T06."""
    return stations.orderBy(F.desc("capacity"), "station_id").limit(top)


def pinned_first(stations: DataFrame, focus: tuple[str, ...]) -> DataFrame:
    """T08."""
    return stations.withColumn("pinned", F.when(F.col("station_id").isin(*focus), 0).otherwise(1)).orderBy("pinned", "station_id")


def station_search(stations: DataFrame, text: str, kind: str | None = None) -> DataFrame:
    """P18."""
    q = text.lower()
    out = stations.where(F.lower("station_name").contains(q) | F.lower("station_id").contains(q))
    return out if kind is None else out.where(F.col("station_type") == kind)


def by_station(df: DataFrame, station: str, bridge: DataFrame) -> DataFrame:
    """Rows of an operational id; a feed id is translated by the bridge (gbfs_id, station_id)."""
    wanted = bridge.where(F.col("gbfs_id") == station).select("station_id").union(df.sparkSession.createDataFrame([(station,)], "station_id string")).distinct()
    return df.join(wanted, "station_id", "left_semi")


def translated(df: DataFrame, bridge: DataFrame) -> DataFrame:
    """Ids of the feed where the bridge has them."""
    unique = bridge.groupBy("station_id").agg(F.min("gbfs_id").alias("gbfs_id"))
    out = df.join(unique, "station_id", "left")
    return out.withColumn("station_id", F.coalesce(F.nullif(F.col("gbfs_id"), F.lit("")), "station_id")).drop("gbfs_id")


def best_rows(predictions: DataFrame, visible: DataFrame) -> DataFrame:
    """Of each visible station, the whole row with the greatest prediction, the earliest of equals."""
    order = F.struct("predicted_demand", -F.unix_seconds(F.col("forecast_hour").cast("timestamp")))
    own = predictions.join(visible.select("station_id"), "station_id", "left_semi")
    return own.groupBy("station_id").agg(F.max_by(F.struct("forecast_hour", "predicted_demand", "model_version"), order).alias("b")).select("station_id", "b.*")


def priority_route(routes: DataFrame, fills: DataFrame, reach: int = 10) -> DataFrame:
    """Routes (route_id, status, stops array of structs with station_id)."""
    stops = routes.where("status = 'active'").select("route_id", F.explode("stops").alias("stop")).select("route_id", F.col("stop.station_id").alias("station_id"))
    urgent = fills.where((F.col("risk") == "critical") & (F.col("fill_pct") <= reach)).select("station_id", F.lit(1).alias("_hit"))
    hits = stops.join(urgent, "station_id", "left").groupBy("route_id").agg(F.count("_hit").alias("urgent_stops"))
    return hits.orderBy(F.desc("urgent_stops"), "route_id").limit(1)


# Lowest and highest value of a request's fields; None: no bound.
REQUEST_RANGES: dict[str, tuple[float | None, float | None]] = {
    "capacity": (1, None), "hour_of_day": (0, 23), "day_of_week": (0, 6), "month": (1, 12), "year": (2023, None), "is_weekend": (0, 1), "is_holiday": (0, 1),
    "precipitation_mm": (0, None), "wind_speed_kmh": (0, None), "humidity_pct": (0, 100), "weather_code": (0, None), "is_cold": (0, 1), "is_hot": (0, 1), "is_precipitation": (0, 1),
    "demand_lag_1h": (0, None), "demand_lag_24h": (0, None), "demand_lag_168h": (0, None), "rolling_avg_3h": (0, None), "rolling_avg_6h": (0, None), "rolling_avg_24h": (0, None),
}
#: Fields that a request has to have besides: a value, in no range.
REQUEST_FIELDS = ("start_station_id", "temperature_c", "feels_like_c")


def checked_requests(requests: DataFrame) -> DataFrame:
    """P25: requests with their faults, field by field in the rules' order: missing, or out of range; and whether there are none."""
    faults = [F.when(F.col(c).isNull() if c in requests.columns else F.lit(True), F.lit(f"{c}: missing")) for c in REQUEST_FIELDS]
    for c, (low, high) in REQUEST_RANGES.items():
        if c not in requests.columns:
            faults.append(F.lit(f"{c}: missing"))
            continue
        v = F.col(c).cast("double")
        inside = v.isNotNull() & (F.lit(True) if low is None else v >= low) & (F.lit(True) if high is None else v <= high)
        faults.append(F.when(F.col(c).isNull(), F.lit(f"{c}: missing")).when(~inside, F.lit(f"{c}: out of range")))
    return requests.withColumn("faults", F.array_compact(F.array(*faults))).withColumn("accepted", F.size("faults") == 0)


def completed_requests(requests: DataFrame) -> DataFrame:
    """P25: cyclical columns only where a request lacks them."""
    made = cyclical("hour", F.col("hour_of_day"), 24) | cyclical("dow", F.col("day_of_week"), 7) | cyclical("month", F.col("month"), 12)
    return requests.withColumns({k: F.coalesce(F.col(k), v) if k in requests.columns else v for k, v in made.items()})


def station_history(panel: DataFrame, rows: int = 200) -> DataFrame:
    """The last ``rows`` demands of a station, oldest first, and its last capacity."""
    back = Window.partitionBy("start_station_id").orderBy(F.desc("hour"))
    last = panel.withColumn("_n", F.row_number().over(back)).where(F.col("_n") <= rows)
    history = F.transform(F.array_sort(F.collect_list(F.struct("hour", "demand_count"))), lambda x: x["demand_count"].cast("double"))
    return last.groupBy("start_station_id").agg(history.alias("history"), F.max_by("capacity", "hour").alias("capacity"), F.max("hour").alias("last_hour"))


def last_known(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """The values of the latest hour, the least station of it."""
    return matrix.agg(F.min_by(F.struct(*columns), F.struct(-F.unix_seconds(F.col("hour").cast("timestamp")), F.col("start_station_id"))).alias("w")).select("w.*")


def weather_profile(weather: DataFrame, top: int = 3) -> DataFrame:
    """A38's figures of the weather."""
    t, rain = F.col("temperature_c"), F.col("precipitation_mm")
    codes = weather.groupBy("weather_code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "weather_code").limit(top)
    common = codes.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("n"), F.col("weather_code")))), lambda x: x["weather_code"].cast("string")), ",").alias("common_codes"))
    figures = weather.agg(F.round(F.min(t), 6).alias("min_temperature"), F.round(F.max(t), 6).alias("max_temperature"), F.round(F.avg(t), 6).alias("mean_temperature"), F.round(100.0 * F.avg((rain > 0).cast("int")), 4).alias("rainy_pct"), F.round(F.sum(rain), 4).alias("total_precipitation"))
    return figures.crossJoin(common)


def station_feed_profile(stations: DataFrame) -> DataFrame:
    """A38's figures of the stations."""
    return stations.agg(F.count("*").alias("stations"), F.sum("capacity").cast("long").alias("total_capacity"), F.round(F.avg("capacity"), 4).alias("mean_capacity"), F.count_if(F.col("region_id").isNull()).alias("without_region"))
