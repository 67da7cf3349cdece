"""Q1-Q3 over tiny versions of the reference's datasets (FIXTURES §A),
with the expected rows worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reachset.operators.shape import EmptyAudienceError, RowGuard
from reachset.plans.any_signal import TECH_SKILL_IDS, AnySignalParams, reference_any_signal
from reachset.plans.market import MarketParams, reference_market
from reachset.plans.presets import METRO_PRESETS, preset
from reachset.plans.unconverted import UnconvertedParams, reference_unconverted

SCHEMAS = {
    "mailings": "clientName string, campaign string, advertiser_id bigint",
    "job_postings": "dupeStatus int, job_visibility_level string, sponVisibility string, "
    "agg_job_id string, claimed_advertiser_id bigint, jobcountry string, jlmsa string, "
    "jlcity string, jladmin1code string",
    "job_details": "is_sponsor_all int, daily_total_revenue_cents bigint, job_hash string, "
    "agg_job_id_tokenized array<string>, advertiser_id bigint, company string",
    "job_changes": "action string, advertiser_id bigint, job_hash string",
    "job_wizard": "edit int, tosheet string, jobhash string",
    "new_jobs": "advertiser_id bigint, jobagedays int, job_hash string",
    "claimed_jobs": "success int, advertiserId bigint, claimedAggJobId string, "
    "newJobHash string",
    "eligibility": "tokenizedGroups array<string>, event string, advertiserId bigint",
    "new_accounts": "lang string, country string, accountid bigint",
    "clicks": "query string, job_country_code string, joblanguage string, format string, "
    "account_id bigint",
    "mobile_searches": "grp string, page int, rcv string, useragent string, qnorm string, country string, "
    "lang string, account_id bigint",
    "searches": "grp string, page int, rcv string, useragent string, qnorm string, country string, "
    "lang string, account_id bigint",
    "job_alerts": "creationGroups array<string>, alert_country_code string, lang string, "
    "q string, accountId string, country string, ipCity string, ipRegion string, ipCountry string",
    "job_views": "grp string, rcv string, site_country_code string, lang string, "
    "job_title_category string, account_id bigint",
    "profiles": "grps array<string>, country string, extractedSkills array<string>, accountId bigint",
    "sign_ins": "js_ip_country_code string, ipcity string, accountId string",
}
TABLES = {
    "email": "id bigint, emailAddress string",
    "account_names": "account_id bigint, family_name string, given_name string",
    "advertiser_info": "accountId bigint, advertiser_id bigint",
}


def build(spark, data):
    """data: name -> list of dicts (event rows need 'ts')."""
    out = {}
    for name, ddl in {**SCHEMAS, **TABLES}.items():
        is_event = name in SCHEMAS
        full = ("ts timestamp_ntz, " + ddl) if is_event else ddl
        cols = [c.strip().split(" ")[0] for c in full.split(", ") if c.strip()]
        # array<string> contains no ", " so the split above is safe
        rows = [tuple(r.get(c) for c in cols) for r in data.get(name, [])]
        out[name] = spark.createDataFrame(rows, full)
    return out


def ts(s):
    return dt.datetime.fromisoformat(s)


# --------------------------------------------------------------------------
# Q1
# --------------------------------------------------------------------------

Q1_AS_OF = dt.date(2021, 2, 4)  # behaviour window [01-15, 01-23), mail [02-02, 02-03)
IN_WIN = ts("2021-01-20 10:00:00")
MAIL = ts("2021-02-02 09:00:00")
GROUP = "eligible_group"
CLIENT, CAMPAIGN, TEST_ADVERTISER = "Mailer", "go_live", 999


def q1_params(**more):
    return UnconvertedParams(
        client_name=CLIENT, campaign=CAMPAIGN, excluded_advertiser=TEST_ADVERTISER,
        eligibility_group=GROUP, as_of=Q1_AS_OF, **more,
    )


def _job_chain(adv, h, sheet):
    return {
        "eligibility": [
            {"ts": IN_WIN, "tokenizedGroups": ["x", GROUP], "event": "NEW", "advertiserId": adv}
        ],
        "claimed_jobs": [
            {"ts": IN_WIN, "success": 1, "advertiserId": adv, "claimedAggJobId": "c" + h,
             "newJobHash": h}
        ],
        "new_jobs": [{"ts": IN_WIN, "advertiser_id": adv, "jobagedays": 0, "job_hash": h}],
        "job_wizard": [{"ts": IN_WIN, "edit": 1, "tosheet": sheet, "jobhash": h}],
        "job_changes": [
            {"ts": IN_WIN, "action": "UPDATE", "advertiser_id": adv, "job_hash": h}
        ],
    }


def _merge(*parts):
    out = {}
    for p in parts:
        for k, v in p.items():
            out.setdefault(k, []).extend(v)
    return out


def q1_data():
    return _merge(
        _job_chain(101, "hA", "details"),      # optimized, not spent
        _job_chain(102, "hB", "sponsor_step"),  # optimized and spent
        _job_chain(104, "hD", "details"),      # optimized, never mailed
        _job_chain(105, "hE", "details"),
        {
            # 105's eligibility event is outside the window: the chain breaks
            "eligibility": [],
            "mailings": [
                {"ts": MAIL, "clientName": CLIENT, "campaign": CAMPAIGN, "advertiser_id": a}
                for a in (101, 102, 103, 105)
            ]
            + [{"ts": MAIL, "clientName": "Other", "campaign": CAMPAIGN, "advertiser_id": 104}],
            "job_details": [
                {"ts": IN_WIN, "is_sponsor_all": 0, "daily_total_revenue_cents": 500, "job_hash": "hB",
                 "agg_job_id_tokenized": ["aggB1", "aggB2"], "advertiser_id": 102, "company": "Beta"},
                {"ts": ts("2021-01-25"), "advertiser_id": 101, "company": "Acme"},
                {"ts": ts("2021-01-26"), "advertiser_id": 101, "company": "Acme"},
                {"ts": ts("2021-01-25"), "advertiser_id": 104, "company": "Delta"},
            ],
            "job_postings": [
                {"ts": IN_WIN, "dupeStatus": 0, "job_visibility_level": "organic", "agg_job_id": "aggB2",
                 "claimed_advertiser_id": 102},
            ],
        },
    )


def test_q1_unconverted(spark):
    data = q1_data()
    data["eligibility"] = [
        r for r in data["eligibility"] if r["advertiserId"] != 105
    ] + [{"ts": ts("2021-01-10"), "tokenizedGroups": [GROUP], "event": "NEW", "advertiserId": 105}]
    out = reference_unconverted(build(spark, data), q1_params())
    assert out.columns == ["advertiserId", "company"]
    assert out.schema["advertiserId"].dataType.simpleString() == "int"
    assert sorted(tuple(r) for r in out.collect()) == [(101, "Acme")]


def test_q1_spent_needs_sponsored_or_open_level(spark):
    data = q1_data()
    data["job_postings"] = [
        {"ts": IN_WIN, "dupeStatus": 0, "job_visibility_level": "sponsored", "sponVisibility": "paused",
         "agg_job_id": "aggB2", "claimed_advertiser_id": 102},
        {"ts": IN_WIN, "dupeStatus": 1, "job_visibility_level": "organic",
         "agg_job_id": "aggB1", "claimed_advertiser_id": 102},
    ]
    out = reference_unconverted(build(spark, data), q1_params())
    assert sorted(tuple(r) for r in out.collect()) == [(101, "Acme"), (102, "Beta")]


# --------------------------------------------------------------------------
# Q2
# --------------------------------------------------------------------------

Q2_AS_OF = dt.date(2021, 2, 16)
T2 = ts("2020-12-01 12:00:00")
NEW = ts("2021-02-10 12:00:00")


def q2_data():
    search = {"grp": "normal", "page": 1, "rcv": "jsv", "useragent": "mozilla", "country": "br", "lang": "pt"}
    return {
        "clicks": [
            {"ts": T2, "query": "vaga de TI", "job_country_code": "BR", "joblanguage": "pt",
             "format": "web", "account_id": 1},
            {"ts": T2, "query": "motivacao", "job_country_code": "BR", "joblanguage": "pt",
             "format": "web", "account_id": 2},
            {"ts": T2, "query": "java", "job_country_code": "BR", "joblanguage": "pt",
             "format": "unknown", "account_id": 2},
        ],
        "mobile_searches": [{"ts": T2, **search, "qnorm": "java junior", "account_id": 3}],
        "searches": [
            {"ts": T2, **search, "grp": "spider", "qnorm": "java", "account_id": 4},
            {"ts": T2, **search, "qnorm": "desenvolvedor mobile", "account_id": 5},
            {"ts": T2, **search, "qnorm": "java", "account_id": 0},
        ],
        "job_alerts": [
            {"ts": T2, "creationGroups": ["a"], "alert_country_code": "br", "lang": "pt",
             "q": "desenvolvedor c#", "accountId": "6"},
            {"ts": T2, "creationGroups": ["privileged"], "alert_country_code": "br", "lang": "pt",
             "q": "java", "accountId": "7"},
            {"ts": T2, "creationGroups": [], "alert_country_code": "br", "lang": "pt",
             "q": "java", "accountId": "abc"},
        ],
        "job_views": [
            {"ts": T2, "grp": "normal", "rcv": "jsv", "site_country_code": "br", "lang": "pt",
             "job_title_category": "tech", "account_id": 8},
            {"ts": T2, "grp": "normal", "rcv": "jsv", "site_country_code": "br", "lang": "pt",
             "job_title_category": "sales", "account_id": 12},
        ],
        "profiles": [
            {"ts": T2, "grps": [], "country": "BR", "extractedSkills": ["zzz", TECH_SKILL_IDS[3]],
             "accountId": 9},
            {"ts": T2, "grps": [], "country": "BR", "extractedSkills": ["zzz"], "accountId": 10},
            {"ts": ts("2019-12-01"), "grps": [], "country": "BR",
             "extractedSkills": [TECH_SKILL_IDS[0]], "accountId": 11},
        ],
        "new_accounts": [
            {"ts": NEW, "lang": "pt_BR", "country": "BR", "accountid": 5},
            {"ts": NEW, "lang": "en_US", "country": "US", "accountid": 1},
        ],
    }


def test_q2_any_signal(spark):
    out = reference_any_signal(build(spark, q2_data()), AnySignalParams(as_of=Q2_AS_OF))
    assert out.columns == ["accountId", "firstName"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, ""), (3, ""), (6, ""), (8, ""), (9, "")]


def test_q2_signal_added_never_shrinks(spark):
    data = q2_data()
    base = {r.accountId for r in reference_any_signal(build(spark, data), AnySignalParams(as_of=Q2_AS_OF)).collect()}
    data["job_views"].append(
        {"ts": T2, "grp": "normal", "rcv": "jsv", "site_country_code": "br", "lang": "pt",
         "job_title_category": "techinfo", "account_id": 13}
    )
    more = {r.accountId for r in reference_any_signal(build(spark, data), AnySignalParams(as_of=Q2_AS_OF)).collect()}
    assert base < more and 13 in more


def test_q2_rejects_bad_codes(spark):
    with pytest.raises(ValueError):
        reference_any_signal(build(spark, {}), AnySignalParams(as_of=Q2_AS_OF, country="BRA"))


# --------------------------------------------------------------------------
# Q3
# --------------------------------------------------------------------------

FOCUS = dt.date(2019, 12, 28)
MSA = "Chicago-Naperville-Elgin, IL-IN-WI"
T3 = ts("2019-12-27 08:00:00")


def q3_data():
    post = {"ts": ts("2019-12-10"), "jobcountry": "US", "jlmsa": MSA}
    alert = {"ts": T3, "country": "us", "ipCountry": "US"}
    return {
        "job_postings": [
            {**post, "jlcity": "Chicago", "jladmin1code": "IL"},
            {**post, "jlcity": "Naperville", "jladmin1code": "IL"},
            {**post, "jlcity": "Gary", "jladmin1code": "IN"},
            {**post, "jlcity": "", "jladmin1code": "IL"},
            {**post, "jlmsa": "Other", "jlcity": "Dallas", "jladmin1code": "TX"},
        ],
        "sign_ins": [
            {"ts": T3, "js_ip_country_code": "US", "ipcity": "Naperville", "accountId": "11"},
            {"ts": T3, "js_ip_country_code": "US", "ipcity": "Dallas", "accountId": "12"},
            {"ts": T3, "js_ip_country_code": "US", "ipcity": "Chicago", "accountId": "13"},
        ],
        "new_accounts": [
            {"ts": T3, "country": "US", "accountid": a, "lang": "en_US"} for a in (11, 12, 14)
        ],
        "job_alerts": [
            {**alert, "ipCity": "Gary", "ipRegion": "IN", "accountId": "21"},
            {**alert, "ipCity": "Chicago", "ipRegion": "IL", "accountId": "22"},
            {**alert, "ipCity": "Naperville", "ipRegion": "IL", "accountId": "22"},
            {**alert, "ipCity": "Chicago", "ipRegion": "TX", "accountId": "23"},
            {**alert, "ipCity": "Chicago", "ipRegion": "IL", "accountId": "11"},
            {**alert, "ipCity": "Chicago", "ipRegion": "IL", "accountId": "24"},
            {**alert, "ipCity": "Chicago", "ipRegion": "IL", "accountId": "25"},
            {**alert, "ipCity": "Chicago", "ipRegion": "IL", "accountId": ""},
        ],
        "email": [
            {"id": 11, "emailAddress": "a@x"},
            {"id": 21, "emailAddress": "b@x"},
            {"id": 22, "emailAddress": "c@x"},
            {"id": 24, "emailAddress": "e@x"},
            {"id": 99, "emailAddress": "z@x"},
        ],
        "account_names": [
            {"account_id": 11, "family_name": "Doe", "given_name": "Jane"},
            {"account_id": 22, "family_name": "Roe", "given_name": "Rick"},
        ],
        "advertiser_info": [
            {"accountId": 24, "advertiser_id": 5},
            {"accountId": 25, "advertiser_id": None},
        ],
    }


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_q3_alerts_and_accounts(spark):
    p = MarketParams(focus=FOCUS, city="Chicago", include_metro=True, account_days=3, alert_days=2)
    out = reference_market(build(spark, q3_data()), p)
    assert out.columns == ["accountId", "City", "State", "emailAddress", "lastName", "firstName"]
    assert rows(out) == [
        (11, "Chicago", "IL", "a@x", "Doe", "Jane"),
        (21, "Gary", "IN", "b@x", None, None),
        (22, "Chicago", "IL", "c@x", "Roe", "Rick"),
        (22, "Naperville", "IL", "c@x", "Roe", "Rick"),
        (25, "Chicago", "IL", None, None, None),
    ]


def test_q3_one_row_per_account(spark):
    p = MarketParams(focus=FOCUS, city="Chicago", account_days=3, alert_days=2, one_row_per_account=True)
    got = rows(reference_market(build(spark, q3_data()), p))
    assert [r[0] for r in got] == [11, 21, 22, 25]
    assert got[2] == (22, "Chicago", "IL", "c@x", "Roe", "Rick")


def test_q3_accounts_only_gets_city_literals(spark):
    p = MarketParams(focus=FOCUS, city="Chicago", include_metro=True, account_days=3, alert_days=0)
    assert rows(reference_market(build(spark, q3_data()), p)) == [
        (11, "Chicago", "IL", "a@x", "Doe", "Jane")
    ]


def test_q3_city_only(spark):
    # without the metro list only sign-ins from Chicago itself count: 13 has no account
    p = MarketParams(focus=FOCUS, city="Chicago", include_metro=False, account_days=3, alert_days=2)
    got = rows(reference_market(build(spark, q3_data()), p))
    assert [r[0] for r in got] == [11, 22, 25]


def test_q3_both_off(spark):
    with pytest.raises(ValueError):
        reference_market(build(spark, {}), MarketParams(focus=FOCUS, account_days=0, alert_days=0))


def test_presets():
    assert len(METRO_PRESETS) == 26
    assert preset("Scottsdale", True).ip_city == "Phoenix"
    assert preset("Scottsdale", False).ip_city == "Phoenix"
    assert preset("San Francisco", True).ip_city == "San Francisco"
    assert preset("Chicago", True).ip_city is None
    assert preset("Chicago", True).ip_regions == ("IL", "IN", "WI")
    assert preset("Washington D.C.", False).ip_city == "Washington DC"
    with pytest.raises(ValueError):
        preset("Paris", True)


def test_q1_audience_two_neither(spark):
    # mailed, not optimized and not spent: only 103 (105's chain broke early)
    data = q1_data()
    data["eligibility"] = [
        r for r in data["eligibility"] if r["advertiserId"] != 105
    ]
    data["job_details"].append({"ts": ts("2021-01-25"), "advertiser_id": 103, "company": "Gamma"})
    data["job_details"].append({"ts": ts("2021-01-25"), "advertiser_id": 105, "company": "Eps"})
    p = q1_params(optimized_mode="not_in")
    out = reference_unconverted(build(spark, data), p)
    assert sorted(tuple(r) for r in out.collect()) == [(103, "Gamma"), (105, "Eps")]


def test_guard_names_the_empty_part_and_counts_unusable_ids(spark):
    data = q2_data()
    guard = RowGuard()
    reference_any_signal(build(spark, data), AnySignalParams(as_of=Q2_AS_OF), guard).collect()
    bad = sum(not (r["accountId"] or "0").lstrip("-").isdigit() for r in data["job_alerts"])
    assert guard.check() == {"job_alerts.accountId": bad}
    data["job_views"] = []
    guard = RowGuard()
    reference_any_signal(build(spark, data), AnySignalParams(as_of=Q2_AS_OF), guard).collect()
    with pytest.raises(EmptyAudienceError, match="view"):
        guard.check()


def test_q2_guard_counts_ids_of_every_dataset(spark):
    tables = {
        n: df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.lower() in ("accountid", "account_id")})
        for n, df in build(spark, q2_data()).items()
    }
    guard = RowGuard()
    bad = {}
    for name, key in (("clicks", "account_id"), ("searches", "account_id"), ("mobile_searches", "account_id"),
                      ("job_views", "account_id"), ("profiles", "accountId"), ("new_accounts", "accountid")):
        one = tables[name].limit(1).withColumn(key, F.lit("no number"))
        tables[name] = tables[name].unionByName(one)
        bad[f"{name}.{key}"] = 1
    want = {r.accountId for r in reference_any_signal(build(spark, q2_data()), AnySignalParams(as_of=Q2_AS_OF)).collect()}
    out = reference_any_signal(tables, AnySignalParams(as_of=Q2_AS_OF), guard)
    assert {r.accountId for r in out.collect()} == want
    got = guard.check()
    assert {k: got.get(k) for k in bad} == bad


def test_q3_guard_watches_sources_and_ids(spark):
    data = q3_data()
    tables = build(spark, data)
    tables["sign_ins"] = tables["sign_ins"].withColumn("accountId", F.col("accountId").cast("string"))
    tables["sign_ins"] = tables["sign_ins"].unionByName(tables["sign_ins"].limit(1).withColumn("accountId", F.lit("x")))
    p = MarketParams(focus=FOCUS, city="Chicago", include_metro=True, account_days=3, alert_days=2)
    guard = RowGuard()
    got = rows(reference_market(tables, p, guard))
    assert got == rows(reference_market(build(spark, data), p))
    assert guard.check()["sign_ins.accountId"] == 1
    data["job_alerts"] = []
    guard = RowGuard()
    reference_market(build(spark, data), p, guard).collect()
    with pytest.raises(EmptyAudienceError, match="job alert"):
        guard.check()


def test_q1_reads_shared_datasets_once(spark, tmp_path):
    tables = {}
    for name, df in build(spark, q1_data()).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    for limit in ("-1", "10m"):
        spark.conf.set(broadcast, limit)
        spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
        try:
            out = reference_unconverted(tables, q1_params())
            got = out.collect()
            plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        finally:
            spark.conf.unset(broadcast)
            spark.conf.unset("spark.sql.maxMetadataStringLength")
        assert got == reference_unconverted(build(spark, q1_data()), q1_params()).collect()
        for name in ("eligibility", "claimed_jobs", "new_jobs", "job_wizard", "job_changes"):
            assert plan.count(f"/{name}]") == 1, name


def test_q1_guard_covers_companies(spark):
    data = q1_data()
    guard = RowGuard()
    reference_unconverted(build(spark, data), q1_params(), guard).collect()
    guard.check()
    data["job_details"] = [r for r in data["job_details"] if "company" not in r or r.get("company") == "Beta"]
    guard = RowGuard()
    assert reference_unconverted(build(spark, data), q1_params(), guard).collect() == []
    with pytest.raises(EmptyAudienceError, match="companies"):
        guard.check()


def test_missing_fields_pass_not_equal(spark):
    """A missing field equals nothing: it passes ``!=`` in every plan."""
    data = q2_data()
    for r in data["job_views"] + data["mobile_searches"] + data["searches"]:
        if r.get("grp") not in ("privileged", "spider"):
            r["grp"] = None
    out = reference_any_signal(build(spark, data), AnySignalParams(as_of=Q2_AS_OF))
    assert sorted(r.accountId for r in out.collect()) == [1, 3, 6, 8, 9]


def test_ids_and_lists_stored_otherwise(spark):
    """Ids as text (some unusable) and list fields stored as one value."""
    data = q2_data()
    tables = build(spark, data)
    want = sorted(r.accountId for r in reference_any_signal(tables, AnySignalParams(as_of=Q2_AS_OF)).collect())
    for name, col in (("clicks", "account_id"), ("job_views", "account_id"), ("profiles", "accountId")):
        text = tables[name].withColumn(col, F.col(col).cast("string"))
        tables[name] = text.unionByName(text.withColumn(col, F.lit("abc")))
    tables["job_alerts"] = tables["job_alerts"].withColumn(
        "creationGroups", F.array_join("creationGroups", " ")
    )
    tables["profiles"] = tables["profiles"].withColumn("extractedSkills", F.get("extractedSkills", F.lit(0))).withColumn(
        "grps", F.get("grps", F.lit(0))
    )
    got = reference_any_signal(tables, AnySignalParams(as_of=Q2_AS_OF))
    assert set(r.accountId for r in got.collect()) <= set(want)
    assert len(got.collect()) >= len(want) - 1


@pytest.fixture(scope="module")
def empty_tables(spark):
    return build(spark, {})


@pytest.mark.parametrize("city,metro", sorted(METRO_PRESETS))
def test_every_preset_builds_its_predicates(empty_tables, city, metro):
    pr = preset(city, metro)
    p = MarketParams(focus=FOCUS, city=city, include_metro=metro, account_days=3, alert_days=2)
    plan = reference_market(empty_tables, p)._jdf.queryExecution().optimizedPlan().toString()
    if pr.ip_city is None:
        assert pr.jlmsa in plan and "LeftSemi" in plan
    else:
        assert f"= {pr.ip_city})" in plan or f"={pr.ip_city})" in plan
        assert pr.jlmsa not in plan
    for region in pr.ip_regions:
        assert region in plan


def test_q1_with_lineage_cut_gives_same_rows(spark):
    data = q1_data()
    p = q1_params(cut_lineage=True)
    got = sorted(tuple(r) for r in reference_unconverted(build(spark, data), p).collect())
    p0 = q1_params()
    assert got == sorted(tuple(r) for r in reference_unconverted(build(spark, data), p0).collect())


def test_excluded_out_of_range_id_does_not_fail(spark):
    from reachset.plans.any_signal import any_signal_audience

    big = 2**31 + 5
    signals = [spark.createDataFrame([(1,), (big,)], "accountId bigint")]
    new = spark.createDataFrame([(big,)], "accountId bigint")
    out = any_signal_audience(signals, new)
    assert [tuple(r) for r in out.collect()] == [(1, "")]


# Every predicate of both Q1 chains, one at a time: an advertiser whose
# optimized chain breaks at exactly one predicate must not come out; one
# whose spent chain breaks at exactly one predicate must not be excluded.
OPT_BREAKS = {
    "event": ("eligibility", {"event": "OLD"}),
    "group": ("eligibility", {"tokenizedGroups": ["other"]}),
    "window": ("eligibility", {"ts": ts("2021-01-23 00:00:00")}),
    "success": ("claimed_jobs", {"success": 0}),
    "claimed": ("claimed_jobs", {"claimedAggJobId": ""}),
    "age": ("new_jobs", {"jobagedays": 1}),
    "edit": ("job_wizard", {"edit": 0}),
    "action": ("job_changes", {"action": "CREATE"}),
}
SPENT_BREAKS = {
    "sponsor_all": ("job_details", {"is_sponsor_all": 1}),
    "revenue": ("job_details", {"daily_total_revenue_cents": 0}),
    "dupe": ("job_postings", {"dupeStatus": 1}),
    "level": ("job_postings", {"job_visibility_level": "sponsored", "sponVisibility": "off"}),
    "sheet": ("job_wizard", {"tosheet": "xsponsor"}),
}


def _advertiser(adv, h, sheet="sponsor_x", break_at=None):
    rows = _job_chain(adv, h, sheet)
    rows["mailings"] = [
        {"ts": MAIL, "clientName": CLIENT, "campaign": CAMPAIGN, "advertiser_id": adv}
    ]
    rows["job_details"] = [
        {"ts": IN_WIN, "is_sponsor_all": 0, "daily_total_revenue_cents": 9, "job_hash": h,
         "agg_job_id_tokenized": ["g" + h], "advertiser_id": adv, "company": f"C{adv}"}
    ]
    rows["job_postings"] = [
        {"ts": IN_WIN, "dupeStatus": 0, "job_visibility_level": "jobalert", "agg_job_id": "g" + h,
         "claimed_advertiser_id": adv}
    ]
    if break_at:
        table_name, change = break_at
        rows[table_name] = [{**r, **change} for r in rows[table_name]]
    return rows


def test_q1_every_predicate_matters(spark):
    parts, keep = [], [101]
    parts.append(_advertiser(101, "h101", sheet="details"))  # optimized, never spent
    for i, brk in enumerate(OPT_BREAKS.values()):
        parts.append(_advertiser(300 + i, f"o{i}", sheet="details", break_at=brk))
    for i, brk in enumerate(SPENT_BREAKS.values()):
        parts.append(_advertiser(400 + i, f"s{i}", break_at=brk))
        keep.append(400 + i)
    parts.append(_advertiser(500, "spent"))  # mailed, optimized, spent: excluded
    parts.append(_advertiser(TEST_ADVERTISER, "x"))  # the excluded advertiser
    out = reference_unconverted(build(spark, _merge(*parts)), q1_params())
    assert sorted(r.advertiserId for r in out.collect()) == sorted(keep)


Q2_MISSES = {
    # dataset: list of (changes that must each drop an otherwise matching row)
    "clicks": [
        {"job_country_code": "br"}, {"joblanguage": "es"}, {"format": "unknown"},
        {"account_id": 0}, {"query": "vendas"}, {"ts": ts("2021-02-16 00:00:00")},
    ],
    "mobile_searches": [
        {"grp": "privileged"}, {"grp": "spider"}, {"page": 2}, {"rcv": "web"},
        {"useragent": "catchpoint"}, {"qnorm": "vendas"}, {"country": "BR"}, {"lang": "en"},
    ],
    "job_alerts": [
        {"creationGroups": ["privileged", "x"]}, {"alert_country_code": "pt"}, {"lang": "es"},
        {"q": "vendas"}, {"accountId": "0"}, {"accountId": "abc"},
    ],
    "job_views": [
        {"grp": "spider"}, {"rcv": "web"}, {"site_country_code": "ar"}, {"lang": "es"},
        {"job_title_category": "sales"}, {"account_id": -3},
    ],
    "profiles": [
        {"grps": ["privileged"]}, {"country": "br"}, {"extractedSkills": ["nope"]}, {"accountId": 0},
    ],
}
Q2_BASE = {
    "clicks": {"ts": T2, "query": "java", "job_country_code": "BR", "joblanguage": "pt",
                       "format": "web"},
    "mobile_searches": {"ts": T2, "grp": "normal", "page": 1, "rcv": "jsv", "useragent": "m",
                  "qnorm": "java", "country": "br", "lang": "pt"},
    "job_alerts": {"ts": T2, "creationGroups": ["a"], "alert_country_code": "br", "lang": "pt",
                         "q": "java"},
    "job_views": {"ts": T2, "grp": "normal", "rcv": "jsv", "site_country_code": "br", "lang": "pt",
                "job_title_category": "techhelp"},
    "profiles": {"ts": T2, "grps": ["a"], "country": "BR", "extractedSkills": [TECH_SKILL_IDS[-1]]},
}
Q2_KEY = {"clicks": "account_id", "mobile_searches": "account_id", "job_alerts": "accountId",
          "job_views": "account_id", "profiles": "accountId"}


def test_q2_every_predicate_matters(spark):
    data, want, nxt = {}, set(), 1000
    for name, misses in Q2_MISSES.items():
        key = Q2_KEY[name]
        as_key = str if name == "job_alerts" else int
        data.setdefault(name, []).append({**Q2_BASE[name], key: as_key(nxt)})  # a hit
        want.add(nxt)
        nxt += 1
        for change in misses:
            row = {**Q2_BASE[name], key: as_key(nxt), **change}
            data[name].append(row)
            nxt += 1
    out = reference_any_signal(build(spark, data), AnySignalParams(as_of=Q2_AS_OF))
    assert {r.accountId for r in out.collect()} == want


def test_command_line_runs_q2_and_q3(spark, tmp_path):
    from reachset.run import main

    d2, d3 = tmp_path / "d2", tmp_path / "d3"
    for folder, rows in ((d2, q2_data()), (d3, q3_data())):
        for name, df in build(spark, rows).items():
            df.write.parquet(str(folder / name))
    out2 = str(tmp_path / "q2")
    main(["any_signal", "--data", str(d2), "--out", out2, "--as-of", "2021-02-16"], spark=spark)
    got = spark.read.schema("accountId int, firstName string").json(out2)
    assert sorted(r.accountId for r in got.collect()) == [1, 3, 6, 8, 9]
    layout = '{"job_alerts": {"ids": ["accountId"]}}'
    main(["any_signal", "--data", str(d2), "--out", out2, "--as-of", "2021-02-16", "--mode", "overwrite",
          "--layout", layout, "--require-rows"], spark=spark)
    got = spark.read.schema("accountId int, firstName string").json(out2)
    assert sorted(r.accountId for r in got.collect()) == [1, 3, 6, 8, 9]
    out3 = str(tmp_path / "q3")
    main(["market", "--data", str(d3), "--out", out3, "--focus", "2019-12-28", "--city", "Chicago",
          "--metro", "--alert-days", "2", "--format", "csv"], spark=spark)
    schema = "accountId bigint, City string, State string, emailAddress string, lastName string, firstName string"
    rows = spark.read.schema(schema).option("header", "true").csv(out3).collect()
    assert sorted(r.accountId for r in rows) == [11, 21, 22, 22, 25]
    assert {r.emailAddress for r in rows if r.accountId == 11} == {"a@x"}


def test_q3_alerts_only(spark):
    p = MarketParams(focus=FOCUS, city="Chicago", include_metro=True, account_days=0, alert_days=2)
    assert rows(reference_market(build(spark, q3_data()), p)) == [
        (11, "Chicago", "IL", "a@x", "Doe", "Jane"),
        (21, "Gary", "IN", "b@x", None, None),
        (22, "Chicago", "IL", "c@x", "Roe", "Rick"),
        (22, "Naperville", "IL", "c@x", "Roe", "Rick"),
        (25, "Chicago", "IL", None, None, None),
    ]


def test_q3_scottsdale_uses_phoenix(spark):
    data = q3_data()
    data["job_alerts"].append(
        {"ts": T3, "country": "us", "ipCountry": "US", "ipCity": "Phoenix", "ipRegion": "AZ", "accountId": "31"}
    )
    data["job_alerts"].append(
        {"ts": T3, "country": "us", "ipCountry": "US", "ipCity": "Scottsdale", "ipRegion": "AZ", "accountId": "32"}
    )
    p = MarketParams(focus=FOCUS, city="Scottsdale", include_metro=True, account_days=0, alert_days=2)
    got = rows(reference_market(build(spark, data), p))
    assert got == [(31, "Phoenix", "AZ", None, None, None)]


def test_presets_frame(spark):
    from reachset.plans.presets import presets_frame

    df = presets_frame(spark)
    assert df.count() == 26
    row = df.where("city = 'Boston' and include_metro").collect()[0]
    assert (row.ip_city, row.ip_regions, row.state) == (None, ["MA", "NH"], "MA")


def test_names_attach_only_to_rows_with_an_email(spark):
    from reachset.sources.lookups import attach_profile

    aud = spark.createDataFrame([(1,), (2,), (3,)], "accountId bigint")
    email = spark.createDataFrame([(1, "a@x"), (3, "c@x"), (3, "c2@x")], "id bigint, emailAddress string")
    names = spark.createDataFrame(
        [(1, "Doe", "Jane"), (2, "Roe", "Rick"), (2, "Roe", "R.")],
        "account_id bigint, family_name string, given_name string",
    )
    out = attach_profile(aud, "accountId", email, "id", {"emailAddress": "emailAddress"},
                         names, ("id", "account_id"), {"lastName": "family_name", "firstName": "given_name"})
    got = [tuple(r) for r in out.select("accountId", "emailAddress", "lastName", "firstName").collect()]
    assert sorted(got, key=lambda r: (r[0], r[1] or "")) == [
        (1, "a@x", "Doe", "Jane"),
        (2, None, None, None),
        (3, "c2@x", None, None),
        (3, "c@x", None, None),
    ]


def test_q1_same_rows_without_salting(spark):
    data = q1_data()
    salted = reference_unconverted(build(spark, data), q1_params(measure_from=0))
    plain = reference_unconverted(build(spark, data), q1_params(measure_from=None))
    assert sorted(tuple(r) for r in salted.collect()) == sorted(tuple(r) for r in plain.collect())


@pytest.mark.parametrize("days", [(3, 2), (3, 0), (0, 2)])
def test_all_markets_equal_separate_runs(spark, tmp_path, days):
    from reachset.plans.all_markets import reference_all_markets

    data = q3_data()
    alert = {"ts": T3, "country": "us", "ipCountry": "US"}
    data["job_alerts"] += [
        {**alert, "ipCity": "Phoenix", "ipRegion": "AZ", "accountId": "31"},
        {**alert, "ipCity": "San Francisco", "ipRegion": "CA", "accountId": "32"},
        {**alert, "ipCity": "Sunnyvale", "ipRegion": "CA", "accountId": "22"},
        {**alert, "ipCity": "Mesa", "ipRegion": "AZ", "accountId": "34"},
        {**alert, "ipCity": None, "ipRegion": "AZ", "accountId": "35"},
    ]
    data["sign_ins"].append({"ts": T3, "js_ip_country_code": "US", "ipcity": "Phoenix", "accountId": "14"})
    data["job_postings"].append(
        {"ts": ts("2019-12-10"), "jobcountry": "US", "jlmsa": "Phoenix-Mesa-Scottsdale, AZ", "jlcity": "Mesa", "jladmin1code": "AZ"}
    )
    tables = {}
    for name, df in build(spark, data).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    p = MarketParams(focus=FOCUS, account_days=days[0], alert_days=days[1])
    out = reference_all_markets(tables, p)
    got = {}
    for r in out.collect():
        got.setdefault((r.market, r.metro), []).append(tuple(r)[2:])
    local = build(spark, data)
    some = [("Chicago", True), ("Chicago", False), ("Phoenix", True), ("Scottsdale", False), ("San Francisco", True),
            ("Sunnyvale", True), ("Boston", True), ("Austin", False)]
    for city, metro in METRO_PRESETS if days == (3, 2) else some:
        one = MarketParams(focus=FOCUS, city=city, include_metro=metro, account_days=days[0], alert_days=days[1])
        want = [tuple(r) for r in reference_market(local, one).collect()]
        assert sorted(got.get((city, metro), []), key=repr) == sorted(want, key=repr), (city, metro)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = reference_all_markets(tables, p)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("js_ip_country_code#") <= 3  # one relation and its filter


