"""Golden edge-case inputs (FIXTURES.md §3)."""

from storelens.sources.schemas import APPS_RENAMED, REVIEWS_RAW

N = None

APPS = [
    ("Alpha", "ART", "4.1", "159", "19M", "10,000+", "Free", "0", "Everyone", "Art",
     "January 7, 2018", "1.0", "4.0 and up"),
    ("Alpha", "ART", "4.1", "159", "19M", "10,000+", "Free", "0", "Everyone", "Art",
     "January 7, 2018", "1.0", "4.0 and up"),
    ("Beta", "GAME", "NaN", "7", "8.5k", "500+", "Paid", "$4.99", "Teen", "Action",
     "2018-08-01", N, "5.0 and up"),
    (N, "GAME", "4.0", "1", "1M", "5+", "Free", "0", "Teen", "Action", "2018-08-01", "1",
     "5.0 and up"),
    ("Gamma", "1.9", "19", "3M", "1,000+", "Free", "0", "Everyone", "", "February 11, 2018",
     "1.0", "4.0 and up", N),
    ("Action", N, "19d", "0", "Varies with device", "0+", N, "Everyone", N, N, N, "2018",
     "nan"),
    ("Beta", "GAME", "5.0", "9", "9G", "1,000+", "Paid", "$5.99", "Teen", "Action", "2018",
     "Varies with device", "5.0 and up"),
    ("é", "GAME", "3.0", "x", "xM", " 5 ", "Free", " $1 ", "Teen", "Action", "2018-13-01", "2",
     "5.0 and up"),
]

REVIEWS = [
    ("Alpha", "good", "Positive", "0.5", "0.5"),
    ("Alpha", "good", "POSITIVE", "NULL", "nan"),
    ("Alpha", "bad", "Negative", "-1", "1"),
    ("Beta", N, "Positive", "1", "1"),
    ("Beta", "nan", "Positive", "1", "1"),
    ("Beta", "ok", N, "0.1x", "0"),
    ("Action", "hm", "Mixed", "0", "0"),
    (N, "x", "Positive", "1", "1"),
    ("Zeta", "orphan", "Neutral", "0", "0"),
]


def raw_apps(spark):
    return spark.createDataFrame(APPS, APPS_RENAMED)


def raw_reviews(spark):
    return spark.createDataFrame(REVIEWS, REVIEWS_RAW)


class Golden:
    """The whole model graph over the golden inputs."""

    def __init__(self, spark):
        from storelens import plans
        self.clean_apps = plans.clean_apps(raw_apps(spark))
        self.clean_reviews = plans.clean_reviews(raw_reviews(spark))
        self.stg_apps = plans.stg_apps(self.clean_apps)
        self.stg_reviews = plans.stg_reviews(self.clean_reviews)
        self.dim_apps = plans.dim_apps(self.stg_apps)
        self.dim_categories = plans.dim_categories(self.stg_apps)
        self.fact = plans.fact_app_metrics(self.dim_apps, self.dim_categories, self.stg_reviews)
        self.keyed = plans.fact_app_metrics_keyed(self.stg_apps, self.stg_reviews)
        self.inputs = plans.DashboardInputs(self.keyed, self.dim_apps, self.dim_categories,
                                            self.stg_reviews)
