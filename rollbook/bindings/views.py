"""Register-shaped views of the test tables.

One text per view serves Spark and DuckDB; four macros cover what the two spell
differently. Every view is a projection or aggregation of a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# In order of dependence.
VIEWS = {
    "company_file": """
select lpad(cast(o_orderkey as string),8,'0') company_number,
  'UK'||lpad(cast(o_orderkey as string),8,'0') organisation_id,
  o_orderkey n,
  'Company '||cast(o_orderkey as string) company_name,
  case o_orderstatus when 'F' then 'Active' when 'O' then 'Active - Proposal to Strike Off' else 'Liquidation' end company_status,
  case when o_orderkey%97=0 then '31/02/2020' when o_orderkey%89=0 then '' else @DMY(o_orderdate) end IncorporationDate,
  cast(10000+(o_custkey%60)*500 as string)||' - Activity 2 '||o_orderpriority sic_text_1,
  case when o_orderkey%3=0 then null when o_orderkey%11=0 then 'None Supplied' else cast(10000+(o_orderkey%60)*500 as string)||' - Other' end sic_text_2,
  case when o_orderkey%5=0 then cast(10000+(o_custkey%60)*500 as string)||' - Repeat' end sic_text_3,
  cast(null as string) sic_text_4,
  case when o_orderkey%13=0 then null else cast(o_orderkey as string)||' HIGH STREET' end reg_address_line1,
  case when o_orderkey%7=0 then 'UNIT 4 '||chr(cast(65+o_orderkey%26 as int))||cast(1+o_orderkey%20 as string)||' '||cast(o_orderkey%10 as string)||'AA' when o_orderkey%14=1 then 'se1 9gf' else 'FLOOR 2' end reg_address_line2,
  'TOWN '||cast(o_custkey%50 as string) reg_address_posttown,
  case when o_orderkey%4=0 then null else 'County '||cast(o_orderkey%9 as string) end reg_address_county,
  case when o_orderkey%7=0 or o_orderkey%14=1 then null else chr(cast(65+o_orderkey%26 as int))||cast(1+o_orderkey%20 as string)||' '||cast(o_orderkey%10 as string)||'AA' end reg_address_postcode,
  cast(o_orderdate as date) file_day
from orders""",
    "post_code_mappings": """
select chr(cast(65+p_partkey%26 as int))||cast(1+p_partkey%20 as string)||cast(p_partkey%10 as string)||'AA' Postcode,
  case when p_partkey%19=0 then null else 'County '||cast(p_partkey%7 as string) end County
from part""",
    "sic_code_categories": """
select cast(10+n_nationkey as string) sic_code_category, n_name Category_Description from nation""",
    "sic_counts": """
select sic_code, case substr(sic_code,1,2) when '11' then '-' when '12' then '' when '13' then null else substr(sic_code,1,2) end sic_code_category,
  file_date, counts
from (select sic_code, file_date, count(*) counts
      from (select @DIGITS(sic_text_1) sic_code, cast(date_trunc('month',file_day) as date) file_date from company_file) a
      group by sic_code, file_date) b""",
    "organisation_prev": """
select organisation_id id, company_number, 'Old '||company_name company_name, company_status,
  @PARSE(IncorporationDate) date_formed, date '2001-06-01' last_modified_date, 'seed' last_modified_by,
  case when n%10=0 then 'IE' else 'UK' end country
from company_file where n%3<>0""",
    "sic_code_prev": """
select distinct @DIGITS(sic_text_1) code, organisation_id, company_number,
  md5(company_number||@DIGITS(sic_text_1)) md5,
  case when n%6=0 then date '2001-07-01' else date '2001-06-01' end date_last_modified
from company_file where n%2=0""",
    "geo_prev": """
select n id, address_1, address_2, town, county, post_code, area_location, country, address_type,
  lower(replace(post_code,' ','')) post_code_formatted, organisation_id, md5(organisation_id||post_code) md5_key,
  date '2001-06-01' date_last_modified, 'seed' last_modified_by
from (select n, organisation_id, 'Old '||reg_address_line1 address_1, reg_address_line2 address_2,
        lower(reg_address_posttown) town, reg_address_county county, 'Area '||cast(n%5 as string) area_location,
        case when n%4=0 then coalesce(reg_address_postcode,'') else 'ZZ1 1ZZ' end post_code,
        case when n%6=0 then 'BRANCH' else 'HEAD_OFFICE' end address_type,
        case when n%31=0 then 'IE' else 'UK' end country
      from company_file where n%2=0) g""",
    "rowcounts": """
select cast(date_trunc('month',o_orderdate) as date) file_month, count(*) file_rowcount from orders group by 1""",
    "release_links": """
select page_id, href from (select page_id, @EXPLODE from pages) h""",
    "release_pages": """
select page_id, html||' <a class="x" href="files/BasicCompanyDataAsOneFile-'||cast(@DAYS(page_id) as string)||'.zip">all</a>'
  ||'<A HREF=''BasicCompanyData-'||cast(@DAYS(page_id) as string)||'-part1_7.zip''>part</A>' html
from pages""",
    "raw_file": """
select company_number, company_status, IncorporationDate, sic_text_1, sic_text_2, sic_text_3, sic_text_4,
  case when n%5=0 then company_name||chr(10)||'"Branch, '||cast(n as string)||'"' when n%7=0 then company_name||chr(10)||chr(10)||'x' else company_name end company_name,
  case when n%11=0 then reg_address_line1||chr(10)||',' else reg_address_line1 end reg_address_line1,
  reg_address_line2, reg_address_posttown, reg_address_county, reg_address_postcode
from company_file""",
    "filetracker": """
select href filename, date '2001-06-01' section1,
  case when page_id%4=0 then date '2001-06-02' end section2, cast(null as date) section3
from (select href, min(page_id) page_id from release_links where page_id%2=0 group by href) t""",
}

TABLES = ["orders", "part", "nation", "pages"]

SPARK_MACROS = {
    "@DMY(": "(date_format($1,'dd/MM/yyyy'))",
    "@PARSE(": "(try_to_date($1,'dd/MM/yyyy'))",
    "@DIGITS(": "(regexp_substr($1,'[0-9]+'))",
    "@DAYS(": "date_add(date '1990-01-01', cast((($1)%10000)*17 as int))",
    "@EXPLODE": "explode(regexp_extract_all(html,'href=\"([^\"]+)\"',1)) href",
}
DUCKDB_MACROS = {
    "@DMY(": "(strftime($1,'%d/%m/%Y'))",
    "@PARSE(": "(cast(try_strptime($1,'%d/%m/%Y') as date))",
    "@DIGITS(": "(nullif(regexp_extract($1,'[0-9]+'),''))",
    "@DAYS(": "(date '1990-01-01' + cast((($1)%10000)*17 as integer))",
    "@EXPLODE": "unnest(regexp_extract_all(html,'href=\"([^\"]+)\"',1)) href",
}


def expand(text: str, macros: dict[str, str]) -> str:
    """Put macro bodies in place of ``@NAME(argument)``."""
    for name, body in macros.items():
        while name in text:
            start = text.index(name)
            if not name.endswith("("):
                text = text.replace(name, body)
                continue
            end = text.index(")", start)
            argument = text[start + len(name) : end]
            text = text[:start] + body.replace("$1", argument) + text[end + 1 :]
    return text


def needed(text: str) -> list[str]:
    """The views that a text names, directly or through other views, in order."""
    names: list[str] = []
    for name in VIEWS:
        if name in text:
            names += [other for other in needed(VIEWS[name]) if other not in names]
            if name not in names:
                names.append(name)
    return [name for name in VIEWS if name in names]


def view_texts(text: str, macros: dict[str, str]) -> list[str]:
    return [f"{name} as ({expand(VIEWS[name], macros)})" for name in needed(text)]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views, or a table itself, over the Parquet tables of ``sf_dir``."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    texts = view_texts(name, SPARK_MACROS)
    used = [table for table in TABLES if any(f"from {table}" in text for text in texts)]
    sources = [f"{table} as (select * from {{{table}}})" for table in used]
    frames = {table: view(spark, sf_dir, table) for table in used}
    return spark.sql(f"with {', '.join(sources + texts)} select * from {name}", **frames)
