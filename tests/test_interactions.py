"""A build of few columns: the same values from fewer windows."""

import random

import pytest

from micro import timeline

MADE = ("new_device_diversity_risk", "risk_velocity_interaction", "risk_spend_concentration", "rapid_timezone_switch")
LATER = ("amt_over_profile_mean", "amt_drift_5", "hour_drift", "velocity_ratio_1h", "mcc_diversity_ratio", "prior_timezone_red_rate",
         "risk_new_desc_x_prior", "null_device_count")


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    out = []
    for i in range(240):
        day = r.choice([3, 8, 15, 16, 20, 29])
        period = "pretrain" if day < 11 else "train" if day < 24 else "test"
        out.append(dict(customer_id=r.choice([1, 2, 3, None]), event_dttm=f"2024-01-{day:02d} {r.randrange(2):02d}:{r.randrange(60):02d}:00",
                        period=period, target=r.choice([None, 0, 1]) if period == "train" else None, timezone=r.choice([1, 3, None]),
                        operaton_amt=r.choice([None, 5.0, 70.0]), mcc_code=r.choice(["5", "7", None]), compromised=r.choice([0, 1, None]),
                        screen_size=r.choice(["390x800", None]), event_desc=r.randrange(3)))
    return timeline(spark, out)


def test_few_columns_have_the_values_of_the_whole_build(spark, rows, monkeypatch):
    from kestrel.plans import features as build
    staged, real = [], build.cut
    monkeypatch.setattr(build, "cut", lambda df, enabled: staged.append(df) or real(df, enabled))

    def windows():
        return staged.pop()._jdf.queryExecution().optimizedPlan().toString().count("Window [")

    whole = build.build_features(rows).select("event_id", *MADE, *LATER).collect()
    of_whole = windows()
    few = build.build_features(rows, columns=tuple(build.interaction_columns()))
    assert windows() < of_whole / 2
    assert "cust_prev_amt_std" not in few.columns and {"amt_abs", *LATER} <= set(few.columns)
    key = lambda x: str(x)
    assert len(whole) > 20 and sorted(few.select("event_id", *MADE, *LATER).collect(), key=key) == sorted(whole, key=key)
