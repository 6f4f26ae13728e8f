"""The results of the checks in DuckDB SQL, stated independently of the operators."""

from __future__ import annotations

from rollbook.bindings.views import DUCKDB_MACROS, expand, view_texts
from rollbook.sources.schema import REGISTER_NAMES

AS_OF = "date '2001-07-15'"

# Intermediate results that several texts share, in order of dependence.
SHARED = {
    "code_texts": """
select company_number, organisation_id, company_status, file_day, 'sic_text_1' slot, sic_text_1 text from company_file
union all select company_number, organisation_id, company_status, file_day, 'sic_text_2', sic_text_2 from company_file
union all select company_number, organisation_id, company_status, file_day, 'sic_text_3', sic_text_3 from company_file
union all select company_number, organisation_id, company_status, file_day, 'sic_text_4', sic_text_4 from company_file""",
    "candidates": """
select distinct @DIGITS(text) code, organisation_id, company_number, md5(company_number||@DIGITS(text)) md5
from code_texts where text is not null""",
    "totals": """
select file_date, sic_code_category as Category, cast(sum(counts) as bigint) as count,
  md5(cast(file_date as varchar)||sic_code_category) md5_str
from sic_counts group by file_date, sic_code_category""",
    "all_code_pairs": """
select t1.sic_code, t1.file_date first_month, t2.file_date second_month, t1.counts first_month_count, t2.counts second_month_count,
  t2.counts-t1.counts diff, round(100.0::double*(t2.counts-t1.counts)/nullif(t2.counts,0),4) pct_change,
  md5(t1.sic_code||cast(t1.file_date as varchar)||cast(t2.file_date as varchar)) md5_str
from sic_counts t1 join sic_counts t2 on t1.sic_code=t2.sic_code
  and date_trunc('month',t2.file_date)=date_trunc('month',t1.file_date)+interval 1 month""",
    "all_category_pairs": """
select t1.Category sic_code_category, t1.file_date first_month, t2.file_date second_month, t1.count first_month_count, t2.count second_month_count,
  t2.count-t1.count diff, round(100.0::double*(t2.count-t1.count)/nullif(t1.count,0),4) pct_change,
  md5(t1.Category||cast(t1.file_date as varchar)||cast(t2.file_date as varchar)) md5_str
from totals t1 join totals t2 on t1.Category=t2.Category
  and date_trunc('month',t2.file_date)=date_trunc('month',t1.file_date)+interval 1 month
where t1.Category not in ('','-')""",
    "code_report": "select * from all_code_pairs where year(second_month)=2001 and month(second_month)=7",
    "category_report": "select * from all_category_pairs where year(second_month)=2001 and month(second_month)=7",
    "code_report_before": """
select * from all_code_pairs where year(second_month)=2001 and month(second_month)=6
union all select * replace (second_month_count+1 as second_month_count) from code_report where diff>0""",
    "category_report_before": """
select * from all_category_pairs where year(second_month)=2001 and month(second_month)=6
union all select * replace (second_month_count+1 as second_month_count) from category_report where diff>0""",
    "codes_after": """
select coalesce(p.code,b.code) code, coalesce(p.organisation_id,b.organisation_id) organisation_id,
  coalesce(p.company_number,b.company_number) company_number, md5,
  case when b.md5 is not null then @AS_OF else p.date_last_modified end date_last_modified
from sic_code_prev p full join (select * from candidates where md5 is not null) b using (md5)""",
    "organisation_after": """
select coalesce(p.id,b.organisation_id) id, coalesce(p.company_number,b.company_number) company_number,
  case when p.id is null then b.company_name else p.company_name end company_name,
  case when p.id is null then b.company_status else p.company_status end company_status,
  case when p.id is null then @PARSE(b.IncorporationDate) else p.date_formed end date_formed,
  case when b.organisation_id is null then p.last_modified_date else @AS_OF end last_modified_date,
  case when p.id is null then 'organisation insert' when b.organisation_id is not null then 'organisation update' else p.last_modified_by end last_modified_by,
  p.country
from organisation_prev p full join company_file b on p.id=b.organisation_id""",
    "month_loaded": """
select coalesce(b.sic_code,p.sic_code) sic_code,
  case when b.sic_code is null then p.sic_code_category else b.sic_code_category end sic_code_category,
  coalesce(b.file_date,p.file_date) file_date, coalesce(b.counts,p.counts) counts
from sic_counts p full join (
  select regexp_replace(text,'[^0-9]+','','g') sic_code, substr(regexp_replace(text,'[^0-9]+','','g'),1,2) sic_code_category,
    date '2001-07-01' file_date, count(*) counts
  from code_texts where company_status in ('Active','Active - Proposal to Strike Off') and text is not null group by 1, 2) b
on p.sic_code=b.sic_code and p.file_date=b.file_date""",
    "first_county": "select Postcode, min(County) new_county from post_code_mappings where County is not null group by Postcode",
    "repaired": """
select company_number, organisation_id, coalesce(reg_address_postcode,
    nullif(regexp_extract(reg_address_line1||' '||reg_address_line2||' '||reg_address_posttown||' '||reg_address_county,
      '(?i)[A-Z]{1,2}[0-9]+ +[0-9]+[A-Z]+'),'')) reg_address_postcode,
  reg_address_county
from company_file""",
    "filled": """
select company_number, organisation_id, reg_address_postcode,
  case when reg_address_county is null and reg_address_postcode<>'' then new_county else reg_address_county end reg_address_county
from repaired left join first_county on replace(reg_address_postcode,' ','')=Postcode""",
    "geo_batch": "@ADDRESSES from (select * exclude (reg_address_county), reg_address_county county from company_file)",
    "refreshed_batch": """@ADDRESSES from (select f.*, f.reg_address_county county, reg_address_line1, reg_address_line2, reg_address_posttown
  from filled f join company_file using (company_number, organisation_id))""",
    "county_batch": """@ADDRESSES from (select f.*, coalesce(reg_address_county,new_county) county
  from company_file f left join first_county on replace(reg_address_postcode,' ','')=Postcode)""",
}

# The batches of the location table differ in where postcode and county come from.
ADDRESSES = """
select organisation_id, coalesce(reg_address_postcode,'') post_code, md5(organisation_id||coalesce(reg_address_postcode,'')) md5_key,
  reg_address_line1 address_1, reg_address_line2 address_2, reg_address_posttown town, county, county area_location,
  lower(replace(coalesce(reg_address_postcode,''),' ','')) post_code_formatted"""
for _name in ("geo_batch", "refreshed_batch", "county_batch"):
    SHARED[_name] = SHARED[_name].replace("@ADDRESSES", ADDRESSES)

# The location upsert occurs with four batches.
GEO_TEXTS = ["address_1", "address_2", "town", "county", "area_location", "post_code_formatted"]
GEO_AFTER = f"""
select coalesce(p.id, (select max(id) from geo_prev)+1+b.number) id,
  {", ".join(f"case when p.id is null then b.{name} else p.{name} end {name}" for name in GEO_TEXTS)},
  coalesce(p.organisation_id,b.organisation_id) organisation_id, coalesce(p.post_code,b.post_code) post_code, md5_key,
  case when b.number is not null then 'HEAD_OFFICE' else p.address_type end address_type,
  case when p.id is null then 'UK' else p.country end country,
  case when b.number is not null then @AS_OF else p.date_last_modified end date_last_modified,
  case when p.id is null then 'location insert' when b.number is not null then 'location update' else p.last_modified_by end last_modified_by
from geo_prev p full join (select *, (row_number() over (partition by substr(md5_key,1,4) order by md5_key)-1)*65536
  +cast('0x'||substr(md5_key,1,4) as bigint) number from @BATCH) b using (md5_key)"""
SHARED["geo_after"] = GEO_AFTER.replace("@BATCH", "geo_batch")
SHARED["county_geo_after"] = GEO_AFTER.replace("@BATCH", "county_batch")
SHARED["parented_batch"] = "select * from refreshed_batch where organisation_id in (select id from organisation_prev)"
SHARED["parented_geo_after"] = GEO_AFTER.replace("@BATCH", "parented_batch")
SHARED["refreshed_geo_after"] = GEO_AFTER.replace("@BATCH", "refreshed_batch")

KEEP_LATEST = """
select * exclude (id_rank) from (select *, rank() over (partition by organisation_id, address_type='HEAD_OFFICE' and country='UK' order by id desc) id_rank from @GEO)
where not (address_type='HEAD_OFFICE' and country='UK') or id_rank=1"""
SHARED["geo_kept"] = KEEP_LATEST.replace("@GEO", "geo_after")
SHARED["parented_geo_kept"] = KEEP_LATEST.replace("@GEO", "parented_geo_after")
SHARED["refreshed_geo_kept"] = KEEP_LATEST.replace("@GEO", "refreshed_geo_after")

FILE_COLUMNS = """company_number, company_name, company_status, nullif(IncorporationDate,'') IncorporationDate,
  sic_text_1, sic_text_2, sic_text_3, sic_text_4, reg_address_line1, reg_address_line2, reg_address_posttown,
  reg_address_county, reg_address_postcode"""
RELEASE_COUNTS = """select regexp_replace(text,'[^0-9]+','','g') sic_code, substr(regexp_replace(text,'[^0-9]+','','g'),1,2) sic_code_category,
  count(*) counts, date '2001-07-01' file_date
from code_texts where company_status in ('Active','Active - Proposal to Strike Off') and text is not null group by 1, 2"""
SHARED["month_reloaded"] = f"""select sic_code, sic_code_category, counts, file_date from sic_counts where file_date<>date '2001-07-01'
union all {RELEASE_COUNTS}"""
SHARED["code_table"] = """
select *, 'seed' last_modified_by, date '2001-06-01' last_modified_date from all_code_pairs where year(second_month)=2001 and month(second_month)=6
union all select *, 'code report insert', @AS_OF from code_report"""
SHARED["category_table"] = """
select a.*, c.Category_Description category_description from (
  select *, 'seed' last_modified_by, date '2001-06-01' last_modified_date from all_category_pairs where year(second_month)=2001 and month(second_month)=6
  union all select *, 'category report insert', @AS_OF from category_report) a left join sic_code_categories c using (sic_code_category)"""
SHARED["register_refreshed"] = """
select c.* replace (coalesce(f.reg_address_postcode,'') as reg_address_postcode, f.reg_address_county as reg_address_county),
  md5(organisation_id||coalesce(f.reg_address_postcode,'')) md5_key
from company_file c join filled f using (company_number, organisation_id)"""
SHARED["tracker_done"] = """
select * replace (case when section3 is null and section2 is not null then @AS_OF else section3 end as section3) from filetracker"""

GEO_COLUMNS = "id, organisation_id, post_code, md5_key, address_type, country, date_last_modified, last_modified_by"

# Columns of the register that a matched row takes from the batch as they are.
OVERWRITTEN = [
    "company_name", "company_status", "IncorporationDate", "sic_text_1", "sic_text_2",
    "sic_text_3", "sic_text_4", "reg_address_line1", "reg_address_line2",
    "reg_address_posttown", "reg_address_county", "reg_address_postcode",
]
HERE = "file_month=date '2001-07-01'"


def _report_after(report: str, before: str, name: str, inserted: str, updated: str) -> str:
    columns = [
        name, "first_month", "second_month", "first_month_count", "second_month_count", "diff", "pct_change",
    ]
    values = ", ".join(
        f"case when b.md5_str is null then p.{col} else b.{col} end {col}" for col in columns
    )
    return f"""select {values}, md5_str,
  case when p.md5_str is null then '{inserted}' when b.md5_str is not null then '{updated}' else 'seed' end last_modified_by,
  case when b.md5_str is null then date '2001-06-01' else @AS_OF end last_modified_date
from {before} p full join {report} b using (md5_str)"""


# The company file with all columns of the register file; those it lacks say their name and a number, or nothing.
COMPANY_FILE = [
    "company_number", "company_name", "company_status", "IncorporationDate", "sic_text_1", "sic_text_2", "sic_text_3",
    "reg_address_line1", "reg_address_line2", "reg_address_posttown", "reg_address_county", "reg_address_postcode",
]
WIDE = ", ".join(
    name if name in COMPANY_FILE else f"case when n%{at % 5 + 2}<>0 then '{name} '||cast(n%{at + 3} as varchar) end {name}"
    for at, name in enumerate(REGISTER_NAMES)
)
BUT_KEY = [name for name in REGISTER_NAMES if name != "company_number"]


def _digest(name: str, source: str, columns: list[str], doubles: tuple[str, ...] = ()) -> str:
    texts = [f"round({c}*10000)::bigint" if c in doubles else c for c in sorted(columns, key=str.lower)]
    row = "concat_ws('|', " + ", ".join(f"coalesce(cast({text} as varchar),'~')" for text in texts) + ")"
    return f"""select '{name}' table_name, count(*) row_count, cast(sum(cast('0x'||substr(md5({row}),1,8) as bigint)) as bigint) digest from {source}"""


REPORT = ["first_month", "second_month", "first_month_count", "second_month_count", "diff", "pct_change", "md5_str", "last_modified_by", "last_modified_date"]
REFRESHED = [
    _digest("register", "register_refreshed", [*COMPANY_FILE, "sic_text_4", "organisation_id", "file_day", "md5_key"]),
    _digest("organisation", "organisation_after", ["id", "company_number", "company_name", "company_status", "date_formed", "last_modified_date", "last_modified_by", "country"]),
    _digest("sic_code", "codes_after", ["code", "organisation_id", "company_number", "md5", "date_last_modified"]),
    _digest("code_analytics", "code_table", ["sic_code", *REPORT], ("pct_change",)),
    _digest("category_analytics", "category_table", ["sic_code_category", "category_description", *REPORT], ("pct_change",)),
    _digest("geo_location", "refreshed_geo_kept", ["id", *GEO_TEXTS, "organisation_id", "post_code", "md5_key", "address_type", "country", "date_last_modified", "last_modified_by"]),
    _digest("filetracker", "tracker_done", ["filename", "section1", "section2", "section3"]),
]

COUNT_CODES = "(select count(*) from codes_after where year(date_last_modified)=2001 and month(date_last_modified)=7)"
COUNT_LOCATIONS = """(select count(*) from geo_after where year(date_last_modified)=2001 and month(date_last_modified)=7
  and country='UK' and address_type='HEAD_OFFICE')"""
COUNT_ORGANISATIONS = """(select count(*) from organisation_after where year(last_modified_date)=2001 and month(last_modified_date)=7
  and country='UK')"""
COUNT_POTENTIAL = "(select count(*) from (select distinct trim(split_part(text,'-',1)), company_number from code_texts))"

TEXTS = {
    "scan_register": f"select {FILE_COLUMNS} from company_file",
    "scan_sic_columns": "select sic_text_1, sic_text_2, sic_text_3, sic_text_4, company_status from company_file",
    "ingest_fragments": f"select {FILE_COLUMNS}, organisation_id from company_file",
    "ingest_parts": """select * exclude (few) replace (case when few then 'Dissolved' else company_status end as company_status,
  case when few then nullif(IncorporationDate,'') else IncorporationDate end as IncorporationDate)
from (select company_number, company_name, company_status, IncorporationDate, sic_text_1, sic_text_2, sic_text_3, sic_text_4,
  reg_address_line1, reg_address_line2, reg_address_posttown, reg_address_county, reg_address_postcode, organisation_id,
  n%50000<32 and n%3=0 few from company_file)""",
    "cut_raw_file": f"select {FILE_COLUMNS} from raw_file",
    "fragment_counts": RELEASE_COUNTS,
    "export_fragments": "select count(*) rows_total, true within_limit from orders",
    "file_row_counts": "select count(*) file_rowcount from orders",
    "landing_overwrite": "select company_number, company_name, company_status from company_file",
    "release_links": "select page_id, href from release_links",
    "matching_links": """select page_id, href filename, cast(null as date) release_date
from release_links where regexp_full_match(href,'/[a-z]+')""",
    "release_files": """select page_id, 'BasicCompanyDataAsOneFile-'||cast(@DAYS(page_id) as varchar)||'.zip' filename, @DAYS(page_id) release_date
from pages where html is not null""",
    "unprocessed_releases": """select distinct href filename from release_links
where href not in (select filename from filetracker where section1 is not null)""",
    "file_name_parts": """select 'Register-'||cast(file_month as varchar)||'.zip' release_name, file_month release_date,
  'part_'||cast(file_rowcount as varchar)||'.csv' part_name, cast(file_rowcount as integer) part_number from rowcounts""",
    "filter_active": """select company_number, company_status from company_file
where company_status in ('Active','Active - Proposal to Strike Off')""",
    "code_extract_rules": """select distinct text, @DIGITS(text) first_digits, regexp_replace(text,'[^0-9]+','','g') only_digits,
  trim(split_part(text,'-',1)) before_dash from code_texts where text is not null""",
    "content_keys": """select company_number, md5(company_number||@DIGITS(sic_text_2)) code_key,
  md5(organisation_id||reg_address_postcode) geo_key, md5(organisation_id||cast(file_day as varchar)) date_key from company_file""",
    "postcode_normalise": "select company_number, lower(replace(reg_address_postcode,' ','')) post_code_formatted from company_file",
    "parse_dates": "select company_number, @PARSE(IncorporationDate) date_formed from company_file",
    "previous_month": "select file_month, cast(file_month - interval 1 month as date) previous_month from rowcounts",
    "changed_in_month": """select code, organisation_id, company_number, md5, date_last_modified from sic_code_prev
where year(date_last_modified)=2001 and month(date_last_modified)=7""",
    "touched_today": "select count(*) touched from sic_code_prev where date_last_modified=date '2001-07-01'",
    "unpivot_codes": "select company_number, slot, text from code_texts",
    "active_code_counts": """select regexp_replace(text,'[^0-9]+','','g') sic_code, count(*) sic_code_count from code_texts
where company_status in ('Active','Active - Proposal to Strike Off') and text is not null group by 1""",
    "monthly_code_counts": """select sic_code, substr(sic_code,1,2) sic_code_category, count(*) counts, file_date
from (select regexp_replace(text,'[^0-9]+','','g') sic_code, cast(date_trunc('month',file_day) as date) file_date from code_texts
  where company_status in ('Active','Active - Proposal to Strike Off') and text is not null) group by sic_code, file_date""",
    "code_candidates": "select code, organisation_id, company_number, md5 from candidates",
    "potential_code_entries": f"select {COUNT_POTENTIAL} potential_sic_code_entries",
    "upsert_codes": "select code, organisation_id, company_number, md5, date_last_modified from codes_after",
    "rejected_codes": """select distinct cast(null as varchar) code, organisation_id, company_number, cast(null as varchar) md5, @AS_OF date_last_modified
from code_texts where text is not null and @DIGITS(text) is null""",
    "category_totals": "select file_date, Category, count, md5_str from totals",
    "insert_new_totals": """select file_date, Category, count, md5_str from totals
where file_date < date '2001-01-01' or md5_str is not null""",
    "code_month_over_month": "select * from code_report",
    "aggregate_month_over_month": "select * from category_report",
    "backfill_codes": "select * from all_code_pairs where month(second_month)<>12",
    "backfill_categories": "select * from all_category_pairs where month(second_month)<>12",
    "backfill_codes_all_months": "select * from all_code_pairs",
    "fill_descriptions": """select r.*, c.Category_Description category_description
from category_report r left join sic_code_categories c using (sic_code_category)""",
    "upsert_code_analytics": _report_after(
        "code_report", "code_report_before", "sic_code", "code report insert", "code report update"
    ),
    "upsert_category_analytics": "select a.*, c.Category_Description category_description from ("
    + _report_after(
        "category_report", "category_report_before", "sic_code_category",
        "category report insert", "category report update",
    )
    + ") a left join sic_code_categories c using (sic_code_category)",
    "upsert_register": f"""select company_number, organisation_id,
  {", ".join(f"case when b.is_in then b.{col} else p.{col} end {col}" for col in OVERWRITTEN)},
  case when b.is_in then null else p.phone_number end phone_number,
  case when b.is_in then null else p.md5_key end md5_key,
  case when b.is_in then @AS_OF else date '2001-06-01' end last_modified_date,
  case when p.company_number is null then 'register insert release' when b.is_in then 'register update release' else 'seed' end last_modified_by
from (select * replace ('Dormant' as company_status), '0' phone_number, md5(organisation_id) md5_key from company_file where file_day < date '2000-01-01') p
full join (select *, true is_in from company_file where file_day >= date '1997-01-01') b using (company_number, organisation_id)""",
    "upsert_register_wide": f"""select company_number, organisation_id,
  {", ".join(f"case when b.is_in then b.{name} else p.{name} end {name}" for name in BUT_KEY)},
  case when b.is_in then null else 'd' end Date_Of_Insert, case when b.is_in then null else 's' end SourceFile,
  case when b.is_in then null else '0' end phone_number, case when b.is_in then null else '1' end number_of_employees,
  case when b.is_in then null else md5(organisation_id) end md5_key,
  case when b.is_in then @AS_OF else date '2001-06-01' end last_modified_date,
  case when p.company_number is null then 'register insert release' when b.is_in then 'register update release' else 'seed' end last_modified_by
from (select company_number, organisation_id, {", ".join(f"'old '||{name} {name}" for name in BUT_KEY)}
  from (select organisation_id, {WIDE} from company_file where file_day < date '2000-01-01')) p
full join (select organisation_id, {WIDE}, true is_in from company_file where file_day >= date '1997-01-01') b using (company_number, organisation_id)""",
    "upsert_organisation": "select * from organisation_after",
    "postcode_repair": "select company_number, reg_address_postcode from repaired",
    "postcode_repair_variants": """select company_number,
  nullif(regexp_extract(a,'(?i)[A-Z]{1,2}[0-9]+ +[0-9]+[A-Z]+'),'') found,
  nullif(regexp_extract(a,'[A-Z]{1,2}[0-9]+ +[0-9]+[A-Z]+'),'') found_exact_case,
  nullif(regexp_extract(s,'(?i)[A-Z]{1,2}[0-9]+ +[0-9]+[A-Z]+'),'') found_skipping_nulls
from (select company_number, reg_address_line1||' '||reg_address_line2||' '||reg_address_posttown||' '||reg_address_county a,
  concat_ws(' ',reg_address_line1,reg_address_line2,reg_address_posttown,reg_address_county) s from company_file)""",
    "county_candidates": """select organisation_id, min(new_county) new_county
from company_file join first_county on replace(reg_address_postcode,' ','')=Postcode
where reg_address_county is null and reg_address_postcode<>'' group by organisation_id""",
    "fill_counties": """select company_number, reg_address_postcode, coalesce(reg_address_county,new_county) reg_address_county
from company_file left join first_county on replace(reg_address_postcode,' ','')=Postcode""",
    "geo_keys": """select company_number, coalesce(reg_address_postcode,'') reg_address_postcode,
  md5(organisation_id||coalesce(reg_address_postcode,'')) md5_key from company_file""",
    "project_geo_rows": """select reg_address_line1 address_1, reg_address_line2 address_2, reg_address_posttown town, reg_address_county county,
  post_code, reg_address_county area_location, 'UK' country, 'HEAD_OFFICE' address_type, lower(replace(post_code,' ','')) post_code_formatted,
  organisation_id, md5(organisation_id||post_code) md5_key, @AS_OF date_last_modified, 'location insert' last_modified_by
from (select *, coalesce(reg_address_postcode,'') post_code from company_file)""",
    "orphan_locations": "select organisation_id, post_code, md5_key from geo_batch where organisation_id not in (select id from organisation_prev)",
    "parented_locations": "select organisation_id, post_code, md5_key from geo_batch where organisation_id in (select id from organisation_prev)",
    "upsert_locations": f"select {GEO_COLUMNS} from geo_after",
    "upsert_locations_wide": f"select {GEO_COLUMNS}, {', '.join(GEO_TEXTS)} from county_geo_after",
    "head_office_rank": """select id, organisation_id, cast(rank() over (partition by organisation_id order by id desc) as integer) id_rank
from geo_after where address_type='HEAD_OFFICE' and country='UK'""",
    "keep_latest_head_office": f"select {GEO_COLUMNS} from geo_kept",
    "rowcount_codes": f"""select *, case when {HERE} then {COUNT_POTENTIAL} end potential_sic_code_entries,
  case when {HERE} then {COUNT_CODES} end rows_changed_in_siccode from rowcounts""",
    "rowcount_locations": f"select *, case when {HERE} then {COUNT_LOCATIONS} end rows_changed_in_geolocation from rowcounts",
    "rowcount_organisations": f"select *, case when {HERE} then {COUNT_ORGANISATIONS} end rows_changed_in_org from rowcounts",
    "rowcount_diffs": f"""select *, file_rowcount-rows_changed_in_geolocation geolocation_diff,
  file_rowcount-rows_changed_in_org organisation_diff, file_rowcount-rows_changed_in_siccode sic_code_diff
from (select *, case when {HERE} then {COUNT_POTENTIAL} end potential_sic_code_entries,
  case when {HERE} then {COUNT_CODES} end rows_changed_in_siccode,
  case when {HERE} then {COUNT_LOCATIONS} end rows_changed_in_geolocation,
  case when {HERE} then {COUNT_ORGANISATIONS} end rows_changed_in_org from rowcounts)""",
    "section_gate": "select * from filetracker where section3 is null and section2 is not null",
    "mark_done": """select * replace (case when section3 is null and section2 is not null then @AS_OF else section3 end as section3)
from filetracker""",
    "refresh_addresses": """select company_number, coalesce(reg_address_postcode,'') reg_address_postcode, reg_address_county,
  md5(organisation_id||coalesce(reg_address_postcode,'')) md5_key from filled""",
    "refresh_locations": f"select {GEO_COLUMNS} from refreshed_geo_kept",
    "refresh_parented_locations": f"select {GEO_COLUMNS} from parented_geo_kept",
    "load_month": "select sic_code, sic_code_category, file_date, counts from month_loaded",
    "load_month_totals": """select file_date, Category, count, md5_str from totals where file_date < date '2001-01-01'
union all select file_date, sic_code_category, cast(sum(counts) as bigint), md5(cast(file_date as varchar)||sic_code_category)
from month_loaded where sic_code_category is not null and file_date >= date '2001-01-01' group by file_date, sic_code_category""",
    "refresh_codes": "select code, organisation_id, company_number, md5, date_last_modified from codes_after",
    "refresh_codes_report": "select * from code_table",
    "refresh_codes_categories": "select * from category_table",
    "refresh_codes_rejects": """select distinct cast(null as varchar) code, organisation_id, company_number, cast(null as varchar) md5, @AS_OF date_last_modified
from code_texts where text is not null and @DIGITS(text) is null""",
    "reload_month": "select sic_code, sic_code_category, counts, file_date from month_reloaded",
    "reload_month_totals": """select file_date, sic_code_category as Category, cast(sum(counts) as bigint) as count,
  md5(cast(file_date as varchar)||sic_code_category) md5_str from month_reloaded group by file_date, sic_code_category""",
    "refresh_all": " union all ".join(REFRESHED),
}


def _shared_texts(text: str) -> dict[str, str]:
    names: dict[str, str] = {}
    for name in reversed(SHARED):
        if name in text or any(name in other for other in names.values()):
            names[name] = SHARED[name]
    return {name: names[name] for name in SHARED if name in names}


def oracle_text(text: str) -> str:
    """The text with the views it needs as common table expressions."""
    shared = _shared_texts(text)
    parts = view_texts(" ".join([text, *shared.values()]), DUCKDB_MACROS)
    parts += [f"{name} as ({body})" for name, body in shared.items()]
    full = f"with {', '.join(parts)} {text}" if parts else text
    return expand(full.replace("@AS_OF", AS_OF), DUCKDB_MACROS)


TEXTS["keep_head_office_by_state"] = TEXTS["keep_latest_head_office"]
TEXTS["newest_head_offices"] = """select organisation_id, max(id) id from geo_after
where address_type='HEAD_OFFICE' and country='UK' and organisation_id is not null group by 1"""
TEXTS["rowcount_observed"] = TEXTS["rowcount_diffs"]

ORACLES = {name: oracle_text(text) for name, text in TEXTS.items()}
