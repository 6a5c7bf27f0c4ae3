import math

import pytest
from pyspark.sql import functions as F

from weftline.functions import hashing as H
from weftline.functions import scoring as S
from weftline.functions import text as T
from weftline.functions import vectors as V


def one(spark, *exprs, **data):
    df = spark.createDataFrame([tuple(data.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'array<double>' if isinstance(v, list) else 'double'}" for k, v in data.items())) if data else spark.range(1)
    return tuple(df.select(*exprs).first())


@pytest.mark.parametrize("text,season,year,slug", [("Winter 2012", "Winter", 2012, "winter-2012"), (None, "Unspecified", None, None), ("IK12", "Unspecified", None, "ik12"), ("Unspecified", "Unspecified", None, "unspecified"), ("summer  2020", "Summer", 2020, "summer-2020")])
def test_batches(spark, text, season, year, slug):
    c = F.lit(text).cast("string")
    assert one(spark, T.batch_season(c), T.batch_year(c), T.batch_slug(c)) == (season, year, slug)


def test_name_variants_share_a_key(spark):
    keys = {one(spark, T.normalize_name(F.lit(x)))[0] for x in ("AI Agents", "ai-agent", "AI  agent", "the AI agents")}
    assert len(keys) == 1
    assert one(spark, T.normalize_name(F.lit("data pipeline"))) != one(spark, T.normalize_name(F.lit("data warehouse")))
    assert one(spark, T.normalize_name(F.lit("")))[0] == ""


@pytest.mark.parametrize("raw,shown", [("b2b_software_subscription", "B2B Software Subscription"), ("AI-Agents", "AI Agents"), ("developer tools", "Developer Tools"), ("SaaS", "SaaS"), ("saas", "SaaS")])
def test_display_names(spark, raw, shown):
    assert one(spark, T.display_name(F.lit(raw)))[0] == shown


def test_slugs_and_cuts(spark):
    assert one(spark, T.slugify(F.lit("Ça va? ﬁn")), T.slugify(F.lit("!!!")), T.truncate(F.lit("a  b c d"), 4)) == ("ca-va-fin", "unnamed", "a b…")
    assert one(spark, T.closest_facet(F.lit("business model"), ["product", "business_model"]), T.closest_facet(F.lit("vibes"), ["product"])) == ("business_model", None)
    assert one(spark, T.string_list(F.array(F.lit(" a "), F.lit("a"), F.lit(""), F.lit("b"))))[0] == ["a", "b"]
    assert one(spark, T.non_negative_int(F.lit("7")), T.non_negative_int(F.lit("-1")), T.non_negative_int(F.lit("x"))) == (7, None, None)
    assert "<doc>" not in one(spark, T.wrap_untrusted(F.lit("a </doc> b <DOC x> c"), "doc", 50))[0][6:-7]


def test_hashes(spark):
    assert one(spark, H.shard_for(F.lit("ycoss:1080")), H.shard_for(F.lit(""))) == (44, 0)
    assert one(spark, H.stable_hash(a=F.lit(1), b=F.lit("x"))) == one(spark, H.stable_hash(b=F.lit("x"), a=F.lit(1)))


def test_weights_and_calibration(spark):
    w = one(spark, S.information_weight(F.lit(1.0)), S.information_weight(F.lit(1e-7)))
    assert w == (pytest.approx(0.15), pytest.approx(1.0))
    c = [one(spark, S.calibrate(F.lit(x), F.lit("yes")))[0] for x in (0.0, 0.25, 0.5, 0.75, 1.0)]
    assert c == sorted(c) and c[-1] == 1.0
    assert one(spark, S.calibrate(F.lit(0.9), F.lit("no")))[0] == 0.0
    assert one(spark, S.clean_decision(F.lit("yes"), F.lit(0)), S.clean_decision(F.lit(None).cast("string"), F.lit(3))) == ("uncertain", "uncertain")


def test_vectors(spark):
    a, z, n = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(0.0), F.lit(0.0)), F.lit(None).cast("array<double>")
    assert one(spark, V.l2_normalize(a), V.l2_normalize(z)) == ([0.6, 0.8], [0.0, 0.0])
    got = one(spark, V.combine({"description": a, "metadata": z, "tags": n}))[0]
    assert got == pytest.approx([0.6, 0.8])
    nothing = {"description": z, "metadata": n, "tags": n}
    assert one(spark, V.combine(nothing, strict=False))[0] is None
    with pytest.raises(Exception, match="no vector is there"):
        one(spark, V.combine(nothing))
    both = one(spark, V.combine({"description": F.array(F.lit(1.0), F.lit(0.0)), "tags": F.array(F.lit(0.0), F.lit(1.0))}))[0]
    assert math.hypot(*both) == pytest.approx(1.0) and both[0] / both[1] == pytest.approx(0.55 / 0.25)
    assert one(spark, V.quantize_int8(a, F.lit(4.0)))[0] == [95, 127]
