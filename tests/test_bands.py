from sluice.operators.bands import (
    DIM_CLOUD,
    DIM_LIFTED_INDEX,
    DIM_LIFTED_INDEX_LEGACY,
    DIM_PREC_AMOUNT,
    DIM_RH,
    DIM_SNOW_DEPTH,
    DIM_WIND_SPEED,
    band_dimension,
    weather_band_dimensions,
)
from sluice.sources.html import html_table

CLOUD = [(1, "0%-6%"), (2, "6%-19%"), (3, "19%-31%"), (4, "31%-44%"), (5, "44%-56%"), (6, "56%-69%"),
         (7, "69%-81%"), (8, "81%-94%"), (9, "94%-100%")]
LIFTED = [(-10, "Below -7"), (-6, "-7 to -5"), (-4, "-5 to -3"), (-1, "-3 to 0"), (2, "0 to 4"),
          (6, "4 to 8"), (10, "8 to 11"), (15, "Over 11")]
RH = [(-4, "0%-5%"), (-3, "5%-10%"), (15, "95%-99%"), (16, "100%")]
WIND = [(1, "Below 0.3m/s (calm)"), (2, "0.3-3.4m/s (light)"), (3, "3.4-8.0m/s (moderate)"),
        (8, "Over 32.6m/s (hurricane)")]
PREC = [(0, "None"), (1, "0-0.25mm/hr"), (2, "0.25-1mm/hr"), (9, "Over 75mm/hr")]
SNOW = [(0, "None"), (1, "0-1cm"), (2, "1-5cm"), (9, "Over 250cm")]


def _table(spark):
    rows = []
    for var, items in (("Cloud Cover", CLOUD), ("Lifted Index", LIFTED), ("Relative Humidity", RH),
                       ("Wind Speed", WIND), ("Precipitation Amount", PREC), ("Snow Depth", SNOW)):
        rows += [(var, str(code), text) for code, text in items]
    return spark.createDataFrame(rows, "Variable string, Value string, Meaning string")


def _rows(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}


def test_cloud(spark):
    d = _rows(band_dimension(_table(spark), DIM_CLOUD))
    assert d[1] == (0, 6) and d[9] == (94, 100) and len(d) == 9


def test_lifted_index_default_and_legacy(spark):
    d = _rows(band_dimension(_table(spark), DIM_LIFTED_INDEX))
    assert d[-10] == (None, -7)
    assert d[-6] == (-7, -5)
    assert d[15] == (11, 11)
    legacy = _rows(band_dimension(_table(spark), DIM_LIFTED_INDEX_LEGACY))
    assert legacy[-10] == (0, -7)


def test_rh_last_band(spark):
    d = _rows(band_dimension(_table(spark), DIM_RH))
    assert d[-4] == (0, 5) and d[16] == (99, 100)


def test_wind_speed_with_description(spark):
    d = _rows(band_dimension(_table(spark), DIM_WIND_SPEED))
    assert d[1] == ("calm", 0.0, 0.3)
    assert d[2] == ("light", 0.3, 3.4)
    assert d[8] == ("hurricane", 55.9, 55.9)


def test_prec_and_snow(spark):
    p = _rows(band_dimension(_table(spark), DIM_PREC_AMOUNT))
    assert p[0] == (0.0, 0.0) and p[1] == (0.0, 0.25) and p[9] == (75.0, 75.0)
    s = _rows(band_dimension(_table(spark), DIM_SNOW_DEPTH))
    assert s[2] == (1.0, 5.0) and s[9] == (250.0, 250.0)


def test_all_six(spark):
    dims = weather_band_dimensions(_table(spark))
    assert set(dims) == {"DIM_cloud", "DIM_lifted_index", "DIM_rh", "DIM_wind_speed", "DIM_prec_amount",
                         "DIM_snow_depth"}
    assert dims["DIM_wind_speed"].columns == ["wind_speed", "description", "min", "max"]


def _html():
    def table(rows):
        body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
        return f"<table class='x'>{body}</table>"
    band = table([("Variable", "Value", "Meaning")] + [("Cloud Cover", str(c), m) for c, m in CLOUD]
                 + [("Wind Speed", str(c), m) for c, m in WIND])
    other = table([("a", "b"), ("1", "2")])
    return f"<html><body>{other}{band}{other}{other}{other}</body></html>"


def test_html_table_then_band_dimension(spark):
    pages = spark.createDataFrame([(1, _html())], "page_id long, html string")
    t = html_table(pages, -4)
    assert t.columns == ["page_id", "row_idx", "Variable", "Value", "Meaning"]
    assert t.count() == len(CLOUD) + len(WIND)
    d = _rows(band_dimension(t, DIM_WIND_SPEED))
    assert d[2] == ("light", 0.3, 3.4)
