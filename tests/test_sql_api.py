from clickscope.functions.sql_functions import register_sql_functions
from clickscope.params import FIXTURE_PARAMS, TaskParams
from clickscope.plans.area_sql import area_top3_sql
from clickscope.plans.jobs import area_top3_job
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT concat_long_string(7, 'x', ':') AS a, "
                  "get_json_field('{\"product_status\":1}', 'product_status') AS b").first()
    assert (r.a, r.b) == ("7:x", "1")


def test_area_sql_equals_dataframe_form(spark):
    a = area_top3_sql(spark, SF, FIXTURE_PARAMS)
    b = area_top3_job(spark, SF, FIXTURE_PARAMS)
    assert rows(a) == rows(b)
    assert "PythonUDF" not in a._jdf.queryExecution().executedPlan().toString()


def test_params_from_json():
    p = TaskParams.from_json({"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": "20",
                              "endAge": "50", "professionals": "", "cities": None, "sex": "male",
                              "keywords": "kw1, kw2", "categoryIds": "", "targetPageFlow": "1,2,3"})
    assert (p.start_age, p.end_age, p.sex, p.professional_list, p.keyword_list, p.category_list, p.flow) == (
        20, 50, "male", None, ("kw1", "kw2"), None, (1, 2, 3))


def test_run_settings_from_json():
    p = TaskParams.from_json({"sampleSize": "7", "sampleSeed": 5, "topCategories": 4, "topSessions": "", "topProducts": None})
    assert (p.sample_size, p.sample_seed, p.top_categories, p.top_sessions, p.top_products) == (7, "5", 4, 10, 3)


def test_params_from_properties(tmp_path):
    from clickscope.params import params_from_properties
    text = ("# run settings\njdbc.url=jdbc:x\n"
            "task.params.json={startDate:\"2024-03-01\", \\\n   endDate:\"2024-03-09\", \\\n"
            "   startAge: 18, \\\n   endAge: 40, \\\n   cities: \"\", \\\n   sex:\"female\"}\n")
    f = tmp_path / "job.properties"
    f.write_text(text)
    p = params_from_properties(str(f))
    assert (p.start_date, p.end_date, p.start_age, p.end_age, p.city_list, p.sex) == (
        "2024-03-01", "2024-03-09", 18, 40, None, "female")
    assert p.flow == (1, 2, 3, 4, 5, 6, 7)  # absent key keeps the default flow
