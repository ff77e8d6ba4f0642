"""Helpers of the tests, under a name that no other folder's module has."""

SF_SMALL = "/root/testdata/sf0.001"


def raw_df(spark, rows):
    """Raw events from dicts (missing keys -> null)."""
    from adlens.constants import RAW_COLUMNS, RAW_SCHEMA
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def event(**kw):
    base = {"event_id": "e1", "timestamp": "2026-02-12T14:30:00Z", "event_type": "install",
            "partner": "Adjust", "cost_usd": 5.5, "app_id": "com.example.puzzle",
            "campaign_id": "spring_launch", "platform": "iOS", "country_code": "US"}
    base.update(kw)
    return base


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
