"""Invented staging tables for the warehouse model tests (no reference data)."""

from __future__ import annotations

import datetime as dt
import unicodedata

from pyspark.sql import functions as F

from lakeward.models import labels as L

D = dt.date
TS = dt.datetime
CO = "company-a"
OTHER = "company-b"
INTERNAL = "reviewer-internal"


def stock(i: int) -> str:
    return L.STOCK_PREFIX + f"{i:032X}"


def staging(spark):
    t = {}

    def add(name, schema, rows):
        t[name] = spark.createDataFrame(rows, schema)

    add("usd_rate", "record_date string, exchange_rate double",
        [("2024-01-01", 24000.0), ("2024-01-02", 24100.0), ("2024-01-02", 24050.0), ("2024-02-01", 24500.0)])
    add("hr_employee", "id int, user_id int, department_id int, name string, job_title string, company_id int",
        [(1, 10, 5, " Ann ", "lead", 1), (2, 10, 6, "Ann B", "dev", 1), (3, 11, 5, "Bo", None, 2),
         (4, None, 5, "  ", "x", 2)])
    add("res_company", "id int, name string", [(1, "Alpha"), (2, " ")])
    add("res_partner", "id int, name string", [(7, "Partner Seven"), (8, " Eight ")])
    add("stream_distro", "isrc string, dailyStream string, reportingDate string, idArtist string, mainArtist string",
        [("IS1", "1,200", "2024-01-01", "a1", "Art One"), ("IS1", "800", "2024-01-15", "a1", "Art One"),
         ("IS2", "2,000,000", "2024-02-03", "a2", "Art Two"), (" ", "5", "2024-01-01", "a3", "X"),
         ("IS3", "10", " ", " ", "Nobody")])
    add("network", "Id string, Name string", [("n1", "Net One"), ("n2", "Net Two")])
    add("partners", f"`{L.PARTNER_NAME_COL}` string, `{L.PROJECT_COL}` string, `{L.PARTNER_REPO_COL}` string, "
        f"`{L.CONTRACT_DATE_COL}` string, `{L.PRICING_COL}` string, _loaded_at timestamp",
        [("P1", "Lo-fi  Beats", None, None, None, TS(2024, 1, 1)), ("P1", None, None, None, None, None),
         (" P1", "lo-fi beats", None, None, None, None), ("", " ", None, None, None, None),
         ("Deep  Co", "Project One", "Deep", "15/02/2024", "fixed", TS(2024, 1, 1)),
         ("DEEP CO", "Project One", None, "01/01/2023", "old", TS(2023, 1, 1))])
    add("x_project", "id int, name string, state string", [(9, "Lo-fi Beats", "open"), (12, "Ambient", "open")])
    add("distro_infomation", f"`{L.PROJECT_COL}` string", [("Ambient / Chill Hop",), ("Dự án",), (" ",)])
    add("sale", "retailer string, isrc string, artist string, reportingPeriod string, revenue string",
        [("Shop", "IS1", "Art One", "2024-01-03", "10.50"), ("Shop", "IS1", "Art One", "2024-01-20", "4.50"),
         ("Shop2", "IS1 ", " ", "2024-01-02", "1.00"), ("Shop", "IS2", "Art Two", "2024-02-01", "7"),
         ("Shop", " ", "Z", "2024-02-01", "9")])
    add("project", "Id string, ProjectName string, ParentId string",
        [("p1", "Root", None), ("p2", "Child", "p1"), ("p3", " ", "p1")])
    add("editings", "Id int, EditingFileId string, Title string, EditingSoftware string, CreatedDate string",
        [(1, "E1", "Edit one", "pr", "2024-01-01 10:00:00"), (2, "E2", "Edit two", "", "2024-01-02 00:00:00"),
         (3, "E3", "Edit three", None, None), (4, " ", "blank", "x", None)])
    add("x_music_plan", "id int, name string, create_date string, date string, state string, create_uid int",
        [(1, "Plan", "2024-01-01", "2024-01", "draft", 3)])
    add("purchase_order", "id int, create_date string, user_id int, company_id int, state string, "
        "date_approve string, name string",
        [(100, "2024-01-01 09:00:00", 10, 1, "purchase", "2024-01-05 00:00:00", "PO100"),
         (101, "2024-01-02 09:00:00", 12, 1, "draft", None, "PO101")])
    add("purchase_order_line", "id int, order_id int, product_qty string, x_subgenre_id int",
        [(1000, 100, "3", 50), (1001, 101, " ", None)])
    add("res_users", "id int", [(10,), (11,), (12,)])
    add("sale_order", "id int, name string", [(500, "SO500")])
    add("sale_order_line", "id int, order_id int, x_purchase_line_id int, create_date string, write_date string, "
        "state string, x_subgenre_id int, product_uom_qty string, x_deadline string, x_expected_score string, "
        "x_produce_qty string, x_qty_in_stock string",
        [(600, 500, 1000, "2024-01-01", "2024-01-03", "sale", 50, "4", "2024-03-01", "8.255", "2", "1"),
         (601, 999, None, None, None, "draft", None, None, None, None, None, None)])
    add("x_music_plan_detail", "id int, plan_id int, produce_manager int, ar_id int, state string",
        [(1, 1, 3, 2, "open")])
    add("x_music_plan_detail_price", "id int, detail_id int, partner_id int", [(1, 1, 7), (2, 1, 99)])
    add("users", "Id int, DisplayName string", [(1, "User One"), (2, "User Two"), (3, "User Three")])
    add("hr_department", "id int, company_id int, name string",
        [(5, 1, '{"en_US": "Sales", "vi_VN": "Kinh doanh"}'), (6, 1, '{"en_US": "Ops"}'), (7, 2, "not json")])
    add("x_music_song", "id int, name string, song_name string, subgenre_id int, review_score string, "
        "review_price string, review_date string, detail_line_id int, state string, produce_state int, "
        "sale_order_id int, purchase_order_line_id int, purchase_order_id string, hg_code string, isrc string, "
        "active boolean, release_state string, release_date string, distro string, cid_state string, "
        "net_cid string, hg_link string, ytb_sent_date string, employee_id string",
        [(1, "S1", "Song 1", 50, "9.5", "100", "2024-01-10", 1, "approved", 6, 600, 1000, "100", stock(1), "IS1",
          True, "released", "2024-01-11", "D1", "cid", "net", "link1", "2024-02-01", "3"),
         (2, "S2", "Song 2", 50, "8", "50", None, 1, "approved", None, None, None, "100", stock(2), "IS2",
          True, "released", None, "D2", None, None, None, None, None),
         (3, "S3", "Song 3", 51, " ", None, None, None, "draft", 1, None, None, None, None, "IS1",
          True, "new", None, None, None, None, None, None, None),
         (4, "S4", "Song 4", 51, None, None, None, None, "rejected", None, None, None, None, None, "IS9",
          False, None, None, None, None, None, None, None, None),
         (5, "S5", "Song 5", 51, None, None, None, None, "other", None, None, None, None, None, None,
          True, None, None, None, None, None, None, None, None)])
    add("departmentlevel", "Id int, Name string", [(1, "Công ty"), (2, "Phòng")])
    add("department", "Id int, Name string, DepartmentLevelId int",
        [(1, "Co A", 1), (2, "Team X", 2), (3, "Co B", 1)])
    add("channel", "Id int, YoutubeChannelId string, Title string, IsDeleted boolean, SuspendedTimeUtc timestamp",
        [(1, "UC1", "Chan 1", False, None), (2, "UC2", "Chan 2", None, None), (3, "UC3", "Chan 3", False, TS(2024, 1, 1)),
         (4, " ", "Blank", False, None), (5, "UC1", "Chan 1 dup", True, None)])
    add("channel_company", "ChannelId int, CompanyId string, IsDeleted boolean, Type string",
        [(1, CO, False, None), (2, CO, None, None), (3, OTHER, False, None), (5, CO, False, "x")])
    add("channel_deal", "ChannelId int, CmsId int, IsDeleted boolean, IsOutNet boolean, ReceiveTimeUtc timestamp, "
        "OutNetTimeUtc timestamp",
        [(1, 1, False, False, TS(2023, 1, 1), None), (2, 2, False, False, None, None),
         (3, 1, False, False, TS(2023, 1, 1), None)])
    add("cms", "Id int, NetworkId string", [(1, "n1"), (2, "n2")])
    add("channel_user", "ChannelId int, UserId int, IsDeleted boolean, CreatedTimeUtc timestamp",
        [(1, 1, False, TS(2024, 1, 1)), (1, 2, False, TS(2024, 2, 1)), (2, 3, True, TS(2024, 1, 1))])
    add("user", "Id int, FullName string", [(1, "Ann"), (2, "Bob"), (3, "Cy")])
    add("channeldepartment", "ChannelId int, DepartmentId int", [(1, 3), (1, 1), (2, 2)])
    add("channel_project", "ChannelId int, ProjectId string", [(1, "p2")])
    add("channel_video_info", "YoutubeVideoId string, YoutubeChannelId string, Code string, PublishedAt timestamp, "
        "Title string",
        [("V1", "UC1", "E1", TS(2024, 1, 5), "Video 1"), ("V1", "UC1", "E1", TS(2024, 1, 6), "Video 1 new"),
         ("V2", "UC2", "E2", None, "Video 2"), ("V3", "UC3", "E3", TS(2024, 1, 7), "Video 3"),
         ("V4", "UC1", " ", TS(2024, 1, 8), "Video 4")])
    add("channel_video_metric", "YoutubeVideoId string, YoutubeChannelId string, Date timestamp, "
        "EstimatedRevenue double, Views double",
        [("V1", "UC1", TS(2024, 1, 1), 10.0, 1000.0), ("V1", "UC1", TS(2024, 1, 2), 20.0, 0.0),
         ("V1", "UC1", TS(2024, 2, 1), 40.0, 4000.0), ("V2", "UC2", TS(2024, 1, 1), 5.0, 500.0),
         ("V3", "UC3", TS(2024, 1, 1), 7.0, 700.0), ("V4", "UC1", TS(2024, 1, 2), None, None),
         (" ", "UC1", TS(2024, 1, 1), 1.0, 1.0)])
    add("resource", "Id int, ResourceFileId string, ResourceType int",
        [(1, stock(1).lower(), 0), (2, stock(2), 0), (3, stock(3), 0), (4, stock(4), 0), (5, stock(5), 0),
         (6, stock(6), 0), (7, "OTHER1", 0), (8, stock(8), 1), (9, stock(9), 0)])
    add("resource_editings", "Id int, EditingId int, ResourcesId int, StartTime double, EndTime double",
        [(11, 1, 1, 0.0, 10.0), (12, 1, 2, 5.0, 6.5), (13, 1, 3, 5.0, 7.0), (14, 1, 4, 9.0, 9.5),
         (15, 1, 5, 12.0, 13.0), (16, 1, 6, 20.0, 21.0), (17, 1, 7, 1.0, 2.0), (18, 1, 8, 1.0, 2.0),
         (21, 2, 2, 0.0, 3.0), (22, 2, 3, 1.0, 2.0), (31, 3, 9, 0.0, 1.0), (41, 4, 1, None, 1.0)])
    add("manual_excluded_stock_codes", "hg_stock_id string", [(" " + stock(9).lower() + " ",), (" ",)])
    add("resource_file_info", "Id int, ResourceFileId string, ISRC string, MediaType int",
        [(1, stock(1), "IS1", 1), (2, stock(2), " IS2 ", 1), (3, stock(9), None, 1), (4, "XFILE", None, 1),
         (5, stock(3), "IS3", 2)])
    add("groups", "Id int, Name string", [(1, "G1"), (2, "G2")])
    add("distribution_media_history", "Id int, ResourceFileInfoId int, CreatedDate string, CreatedByUserId int, "
        "DepartmentData string, GroupData string, UserData string",
        [(1, 1, "2024-01-03", 1, "2,1", "1, 2,3", "3,1"), (2, 2, "2024-01-10", 2, "", None, "9"),
         (3, 3, "2024-01-11", 1, "1", "1", "1"), (4, 4, "2024-01-12", 1, "2", "2", "2"),
         (5, 1, "2024-02-01", 1, "2,1", "1", "1"), (6, 99, "2024-02-02", 3, "3", "1", "2")])
    add("tracking_video_publish_infos", "ResourceFileInfoId int, ResourceFileId string, VideoPublishId string, "
        "ChannelId string, CreatedDate timestamp, VideoType int",
        [(1, stock(1), "YV1", "UC1", TS(2024, 1, 1), 1), (1, stock(1), "YV2", "UC1", TS(2024, 1, 5), 1),
         (2, stock(2), "YV3", "UC2", TS(2024, 1, 2), 2), (5, stock(3), "YV4", "UC1", TS(2024, 1, 3), 1)])
    add("review", "Id int, CreatedByUserId string, Rating double, Concluding int, Comment string, "
        "CreatedDate string, RecordingSoundVersionId int",
        [(1, INTERNAL, 8.5, 1, '{"Comment": "good"}', "2024-01-02", 11), (2, "u2", 7.0, 2, "plain", "2024-01-03", 12),
         (3, "u3", None, 9, None, "2024-01-04", 99)])
    add("review_user", "Id string, FullName string", [(INTERNAL, "Inner"), ("u2", " U Two ")])
    add("recording_sound", "Id int, SongCode string, CreatedDate string", [(1, "S1", "2023-12-01")])
    add("recording_sound_version", "Id int, RecordingSoundId int, CreatedDate string",
        [(11, 1, "2023-12-02"), (12, 1, "2023-12-01"), (13, 1, "2023-12-01")])
    add("user_comment_version", "VersionNeedsCommentId int, UserId string, Rating double",
        [(1, "u2", 8.0), (1, "u3", 9.0), (1, INTERNAL, 1.0), (2, "u2", 6.0)])
    add("version_needs_comment", "Id int, RecordingSoundVersionId int", [(1, 11), (2, 12)])
    add("x_acceptance_cert", "purchase_order_id string, acceptance_link string",
        [("100", "https://cert/b"), ("100", "https://cert/a")])
    add("resource_before_odoo", f"ISRC string, `{L.SONG_CODE_COL}` string, `{L.AVG_SCORE_COL}` string, "
        f"`{L.UNIT_COST_COL}` string, `{L.AR_IN_CHARGE_COL}` string, `{L.ARTIST_COL}` string, Subgenre string, "
        f"`{L.RBO_STOCK_COL}` string, `{L.RBO_TITLE_COL}` string, `{L.GENRE_COL}` string",
        [("IS1", "S1", "9", "10", "ar", "art", "Child", stock(1), "Legacy 1", "Cafe\u0301  Jazz"),
         ("IS7", "S7", "8.5", None, None, None, "Nope", stock(7), "Legacy 7", "CAFÉ JAZZ"),
         (" IS7", "S6", None, None, None, None, None, "hgfa7", "lower code", "Café Jazz"),
         ("#N/A", "S8", None, None, None, None, None, stock(8), "Legacy 8", None),
         ("IS2", "S2", None, None, None, None, "Child", None, None, "ambient")])
    add("resource_files", "Id string, FileName string, CreatedDate timestamp, MediaType int",
        [(stock(1), "one.wav", TS(2023, 6, 1), 1), (stock(2), "Two", TS(2023, 12, 1), 1),
         (stock(3), "Three", None, 1), (stock(4), "Video file", TS(2023, 1, 1), 2), (stock(9), "Nine", TS(2023, 1, 1), 1)])
    add("resource_performance", f"`{L.PERF_STOCK_COL}` string, `{L.PERF_NAME_COL}` string, "
        + ", ".join(f"`{c}` string" for c in L.PERF_ISRC_COLS) + f", `{L.PERF_PROJECT_COL}` string",
        [(stock(5), "Perf 5", None, "ISOLD5", "ISNEW5", "Project"),
         (stock(6), "Perf 6", "IS6", None, None, unicodedata.normalize("NFD", " " + L.UNKNOWN_PROJECT.upper() + " ")),
         (stock(10), "Perf 10", None, None, None, "#n/a")])
    add("purchased_resource", f"`{L.PURCHASED_CODE_COL}` string, `{L.TITLE_COL}` string, `{L.PURCHASED_REPO_COL}` string",
        [(stock(1), "Bought 1", "deep   company"), (stock(11), "Bought 11", "Other"), ("XYZ", "bad code", "Other"),
         (stock(13), "No repo", " ")])
    add("resource_infomation_add", f"ResourceFileId string, `{L.TITLE_COL}` string, ISRC string, `{L.PROJECT_COL}` string",
        [(stock(12), "Added 12", "IS12", "Old Name"), (stock(5), "Added 5", "IS5", "Bỏ bài này")])
    add("resource_storage_history", "ResourceFileInfoId string, ToStatus string", [("2", "Archived"), ("1", "Active")])
    add("phase6_sales", "sale_id string, customer_name string, amount string, sale_date string, _source_id string, "
        "_batch_id string, _loaded_at timestamp",
        [("1", "A", "100.00", "2024-01-01", "src", "b1", TS(2024, 1, 1)),
         ("1", "A", "150.00", "2024-01-01", "src", "b2", TS(2024, 1, 2)),
         ("2", "B", "50", "2024-01-02", "src", "b1", TS(2024, 1, 1)), (" ", "C", "1", "2024-01-02", "src", "b1", None)])
    add("purchase_name_aliases", "canonical_name string, aliases array<string>",
        [("Deep Co", ["Deep Co", "DEEP  CO", "Deep Company"]), ("Other", ["Other"])])
    months = [f"`{L.MONTH_COST_PREFIX}{m}` string" for m in range(1, 13)]
    add("purchase_cost", f"`{L.PARTNER_NAME_COL}` string, _year string, `{L.YEAR_TOTAL_COL}` string, " + ", ".join(months),
        [("deep  co", "2024", "1.200.000", "250.000", None, "0", "", "100.000", *[None] * 7),
         ("Deep Co", "2024", "x", "50.000", *[None] * 11),
         ("Other", "2025", "500000", *[None] * 11, "500000"),
         ("Bad", "24", "1", *[None] * 12)])
    return t


def provided(spark):
    """Stand-ins for the entity-resolution dimensions this library takes as inputs."""
    dpr = spark.createDataFrame(
        [("r1", stock(1), "pa", "Deep Co", "deep co", "15/02/2024"),
         ("r2", stock(2), "pa", "Deep Co", "deep co", None),
         ("r3", stock(3), "pb", "Other", "other", "1/6/2025"),
         ("r4", "BAD", "pb", "Other", "other", None)],
        "dim_purchased_resource_sk string, hg_stock_id string, partner_id string, partner_name string, "
        "partner_key string, buy_date string")
    dsp = spark.createDataFrame([("sp1", "Child", "pj1"), ("sp0", "Không có  dự án con", "pj1")],
                                "sub_project_id string, sub_project_name string, project_id string")
    dstock = spark.createDataFrame(
        [(stock(1), "Stock 1", "IS1"), (stock(2), "Stock 2", "IS2"), (stock(3), "Stock 3", ""), ("OTHER1", "x", None)],
        "hg_stock_id string, name string, isrc string")
    repo = spark.createDataFrame([("50", "sp1", "Deep Co"), ("51", "sp1", "x"), ("52", None, "Other"), ("53", "sp0", "deep co")],
                                 "repository_id string, sub_project_id string, repository_name string")
    proj = spark.createDataFrame([("pj1", "Project One")], "project_id string, project_name string")
    dres = spark.createDataFrame(
        [(stock(1), "50", "1000", "odoo"), (stock(2), "50", "1001", "odoo"), (stock(2), "50", "1001", "odoo"),
         (stock(3), "51", None, "odoo"), (stock(4), "52", "1000", "sheet")],
        "hg_stock_id string, repository_id string, po_detail_id string, resource_source string")
    dres_full = spark.createDataFrame(
        [(stock(1), "Res 1", "odoo", "fixed", "50", "1", "1", dt.datetime(2024, 1, 10), "k1"),
         (stock(1), "Res 1 sheet", "sheet", None, None, None, None, None, "k2"),
         (stock(2), "Res 2", "odoo", None, None, "3", "2", None, "k3"),
         (stock(2), "Res 2b", "odoo", None, "51", None, None, dt.datetime(2023, 1, 1), "k4"),
         (stock(11), "Res 11", "sheet", "share", None, None, None, None, "k5")],
        "hg_stock_id string, resource_name string, resource_source string, repository_type string, "
        "repository_id string, production_plan_detail_id string, odoo_id string, acceptance_date timestamp, "
        "dim_resources_sk string")
    dstock = dstock.withColumn("stock_stored_date", F.lit(None).cast("timestamp")) \
        .withColumn("status", F.lit(L.STOCK_IN_INVENTORY))
    for c, t in (("resource_name", "string"), ("repository_type", "string"), ("production_plan_detail_id", "string"),
                 ("odoo_id", "string"), ("acceptance_date", "timestamp"), ("dim_resources_sk", "string")):
        dres = dres.withColumn(c, F.lit(None).cast(t))
    return {"dim_purchased_resource": dpr, "dim_resources_full": dres_full, "dim_sub_project": dsp, "dim_stock": dstock, "dim_repository": repo,
            "dim_project": proj, "dim_resources": dres}
