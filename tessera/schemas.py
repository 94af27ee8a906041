"""Schemas of the documents, dimension tables and graph tables."""

from __future__ import annotations

SEARCH_RECORD = "eid string, doi string, title string, publication_name string, cover_date string, citedby_count long, open_access string"
PAPER_DETAIL = (
    "eid string, doi string, title string, abstract string, authors string, author_count int, publication_name string, volume string, issue string, "
    "pages string, cover_date string, citedby_count long, open_access string, publisher string, error string"
)
LEDGER = "doi string, downloaded int, llm_processed int, cover_date string"
CONDITION = "struct<condition_name:string,value:variant,unit:string>"
PROPERTY = f"struct<property_name:string,original_property_name:string,value:variant,unit:string,original_value:variant,original_unit:string,test_conditions:array<{CONDITION}>>"
PARAMETER = "struct<parameter_name:string,value:variant,unit:string,original_unit:string,original_value:variant,description:string>"
STEP = f"struct<method:string,precursors:array<string>,parameters:array<{PARAMETER}>>"
MATERIAL = (
    "struct<name:string,formula:string,role:string,morphology:string,original_name:string,electrolyte:boolean,"
    f"synthesis_route:variant,performance_and_properties:array<{PROPERTY}>>"
)
#: An extracted document; the synthesis route is an object or an array of objects, so it stays a variant here.
EXTRACTION = f"struct<metadata:struct<doi:string,title:string>,materials:array<{MATERIAL}>>"
UNIT_CONVERSION = "pos int, original string, si_unit string, factor string"
PROPERTY_MAP = "pos int, property string, normalized string"
BATCH_REQUEST = "struct<recordId:string,modelInput:struct<messages:array<struct<role:string,content:string>>,temperature:double>>"
SECTION_ROW = "doi string, path array<int>, depth int, title string, paragraph_idx int, paragraph string"
TABLE = "struct<caption:string,headers:array<string>,rows:array<array<string>>>"
PARSED_PAPER = (
    "doi string, title string, abstract string, keywords array<string>, "
    f"sections array<struct<path:array<int>,depth:int,title:string,paragraphs:array<string>>>, tables array<{TABLE}>, error string"
)
