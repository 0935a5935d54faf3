"""Sub-projects and repositories: composed and decomposed names, ties, overrides, aliases, missing defaults."""

import datetime as dt
import hashlib
import unicodedata

import pytest

from lakeward.models import ModelContext
from lakeward.models import labels as L


def md5(*parts):
    return hashlib.md5("-".join(parts).encode()).hexdigest()


DEFAULT, DEPOT = L.DEFAULT_SUB_PROJECT, L.DEFAULT_REPOSITORY


def nfd(text):
    return unicodedata.normalize("NFD", text)


@pytest.fixture(scope="module")
def ctx(spark):
    def table(schema, *rows):
        return spark.createDataFrame(list(rows), schema)
    projects = table("project_id string, project_name string", ("9", "Nhạc Êm"), ("129", "Old"), ("163", "New"), ("hx", "Classical"))
    sheets = {
        "x_project": table("id int, name string", (9, nfd("Nhạc  Êm")), (129, "Old"), (163, "New"), (12, "nhạc êm")),
        "x_product_genre": table("id int, project_id int, name string, description string, order_type string",
                                 (5, 9, " Êm ", "note", "music"), (7, 12, nfd("êm"), None, "music"), (8, 129, None, None, "music"),
                                 (6, None, "New", None, "music"), (4, 9, "Film", None, "film")),
        "resource_before_odoo": table(f"`{L.GENRE_COL}` string, `{L.SUBGENRE_COL}` string",
                                      (nfd("NHẠC ÊM"), "Jazz  Cafe"), ("Unheard", "X"), ("New", " ")),
        "resource_performance": table(f"`{L.PERF_PROJECT_COL}` string, `{L.PERF_SUB_PROJECT_COL}` string, `{L.PERF_REPO_COL}` string",
                                      ("nhạc êm", nfd("Êm"), "Kho A"), ("Nhạc Êm", "#N/A", None), ("#N/A", "Y", "Z"),
                                      ("New", "Beats", " Nhạc nền audiojungle "), (nfd("Không xác định"), "Q", "Q")),
        "distro_infomation": table(f"`{L.PROJECT_COL}` string, `{L.SUB_PROJECT_COL}` string, `{L.REPO_COL}` string",
                                   ("Classical", "Classcial bật CID", "Kho B"), ("classical", "Classical bật CID", "kho b"),
                                   ("New", "beats", "Kho C"), ("Dự án", "Dự án con", "Kho")),
        "resource_infomation_add": table(f"`{L.PROJECT_COL}` string, `{L.SUB_PROJECT_COL}` string, `{L.REPO_COL}` string",
                                         ("New", "Fresh", "Kho D"), ("New", "không có", "không có"), ("bỏ bài này", "Z", "Z")),
        "x_product_subgenre": table("id int, product_genre_id int, name string, order_type string",
                                    (1, 5, "Kho A", "music"), (2, 5, "kho a", "music"), (3, 99, "Lost", "music"), (4, None, "No", "music")),
        "partners": table(f"`{L.PARTNER_NAME_COL}` string, `{L.PROJECT_COL}` string", ("Partner One", nfd("Nhạc Êm")), (" ", "New")),
    }
    return ModelContext(spark, sheets, dt.date(2024, 1, 1), provided={"dim_project": projects})


def test_sub_projects(ctx):
    got = {r["sub_project_id"]: (r["project_id"], r["sub_project_name"], r["description"]) for r in ctx.ref("dim_sub_project").collect()}
    unheard = hashlib.md5(b"unheard").hexdigest()
    want = {
        "5": ("9", "Êm", "note"),                       # of 5 and 7, both "êm" of project 9, the smaller id
        "8": ("163", DEFAULT, None),                    # project 129 goes by 163; no name is the default
        "6": ("163", "New", None),                      # without a project: the one of its own name
        md5("9", "Jazz Cafe"): ("9", "Jazz Cafe", None),
        md5(unheard, "X"): (unheard, "X", None),        # an unknown project keeps its hashed name
        md5("9", DEFAULT): ("9", DEFAULT, None),        # from the performance sheet
        md5("163", "Beats"): ("163", "Beats", None),    # the distributor's "beats" finds it
        # both spellings go by one key; of the two names the first in order stays
        md5("hx", "classical bật cid"): ("hx", "Classcial bật CID", None),
        md5("163", "fresh"): ("163", "Fresh", None),
        md5("hx", DEFAULT): ("hx", DEFAULT, None),
    }
    assert got == want


def test_repositories(ctx):
    rows = ctx.ref("dim_repository").collect()
    got = {r["repository_id"]: (r["sub_project_id"], r["repository_name"]) for r in rows}
    nine, beats, fresh = md5("9", DEFAULT), md5("163", "Beats"), md5("163", "fresh")
    assert got["1"] == ("5", "Kho A") and "2" not in got          # the performance sheet's "Kho A" is known, too
    assert got["3"] == ("99", "Lost") and "4" not in got
    assert got[md5("Partner One", nine)] == (nine, "Partner One")
    assert got[md5(DEPOT, nine)] == (nine, DEPOT)                 # a performance row without a repository
    assert got[md5(L.AUDIOJUNGLE, beats)] == (beats, L.AUDIOJUNGLE)
    assert got[md5(beats, "kho c")] == (beats, "Kho C") and got[md5(fresh, "kho d")] == (fresh, "Kho D")
    subs = {r["sub_project_id"] for r in ctx.ref("dim_sub_project").select("sub_project_id").collect()}
    assert subs <= {sub for sub, name in got.values() if name == DEPOT}
    assert len(rows) == len(got)
