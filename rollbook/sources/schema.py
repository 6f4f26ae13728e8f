"""Columns of the register file and of the register table."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the register file, blanks included, and the name
# that each column has in the register table.
REGISTER_COLUMNS = [
    ("CompanyName", "company_name"),
    (" CompanyNumber", "company_number"),
    ("RegAddress.CareOf", "RegAddress_CareOf"),
    ("RegAddress.POBox", "RegAddress_POBox"),
    ("RegAddress.AddressLine1", "reg_address_line1"),
    (" RegAddress.AddressLine2", "reg_address_line2"),
    ("RegAddress.PostTown", "reg_address_posttown"),
    ("RegAddress.County", "reg_address_county"),
    ("RegAddress.Country", "RegAddress_Country"),
    ("RegAddress.PostCode", "reg_address_postcode"),
    ("CompanyCategory", "CompanyCategory"),
    ("CompanyStatus", "company_status"),
    ("CountryOfOrigin", "country_of_origin"),
    ("DissolutionDate", "DissolutionDate"),
    ("IncorporationDate", "IncorporationDate"),
    ("Accounts.AccountRefMonth", "Accounts_AccountRefMonth"),
    ("Accounts.AccountRefDay", "Accounts_AccountRefDay"),
    ("Accounts.NextDueDate", "Accounts_NextDueDate"),
    ("Accounts.LastMadeUpDate", "Accounts_LastMadeUpDate"),
    ("Accounts.AccountCategory", "Accounts_AccountCategory"),
    ("Returns.NextDueDate", "Returns_NextDueDate"),
    ("Returns.LastMadeUpDate", "Returns_LastMadeUpDate"),
    ("Mortgages.NumMortCharges", "Mortgages_NumMortCharges"),
    ("Mortgages.NumMortOutstanding", "Mortgages_NumMortOutstanding"),
    ("Mortgages.NumMortPartSatisfied", "Mortgages_NumMortPartSatisfied"),
    ("Mortgages.NumMortSatisfied", "Mortgages_NumMortSatisfied"),
    ("SICCode.SicText_1", "sic_text_1"),
    ("SICCode.SicText_2", "sic_text_2"),
    ("SICCode.SicText_3", "sic_text_3"),
    ("SICCode.SicText_4", "sic_text_4"),
    ("LimitedPartnerships.NumGenPartners", "LimitedPartnerships_NumGenPartners"),
    ("LimitedPartnerships.NumLimPartners", "LimitedPartnerships_NumLimPartners"),
    ("URI", "URI"),
    ("PreviousName_1.CONDATE", "PreviousName_1_CONDATE"),
    (" PreviousName_1.CompanyName", "PreviousName_1_CompanyName"),
    (" PreviousName_2.CONDATE", "PreviousName_2_CONDATE"),
    (" PreviousName_2.CompanyName", "PreviousName_2_CompanyName"),
    ("PreviousName_3.CONDATE", "PreviousName_3_CONDATE"),
    (" PreviousName_3.CompanyName", "PreviousName_3_CompanyName"),
    ("PreviousName_4.CONDATE", "PreviousName_4_CONDATE"),
    (" PreviousName_4.CompanyName", "PreviousName_4_CompanyName"),
    ("PreviousName_5.CONDATE", "PreviousName_5_CONDATE"),
    (" PreviousName_5.CompanyName", "PreviousName_5_CompanyName"),
    ("PreviousName_6.CONDATE", "PreviousName_6_CONDATE"),
    (" PreviousName_6.CompanyName", "PreviousName_6_CompanyName"),
    ("PreviousName_7.CONDATE", "PreviousName_7_CONDATE"),
    (" PreviousName_7.CompanyName", "PreviousName_7_CompanyName"),
    ("PreviousName_8.CONDATE", "PreviousName_8_CONDATE"),
    (" PreviousName_8.CompanyName", "PreviousName_8_CompanyName"),
    ("PreviousName_9.CONDATE", "PreviousName_9_CONDATE"),
    (" PreviousName_9.CompanyName", "PreviousName_9_CompanyName"),
    ("PreviousName_10.CONDATE", "PreviousName_10_CONDATE"),
    (" PreviousName_10.CompanyName", "PreviousName_10_CompanyName"),
    ("ConfStmtNextDueDate", "ConfStmtNextDueDate"),
    (" ConfStmtLastMadeUpDate", "ConfStmtLastMadeUpDate"),
]

# Columns of the register table that no file fills.
UNFILLED_COLUMNS = ["Date_Of_Insert", "SourceFile", "phone_number", "number_of_employees"]

FILE_HEADER = [header for header, _ in REGISTER_COLUMNS]
REGISTER_NAMES = [name for _, name in REGISTER_COLUMNS]
CODE_TEXTS = ["sic_text_1", "sic_text_2", "sic_text_3", "sic_text_4"]

# Every value is text: inferred types would strip leading zeros off numbers.
FILE_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in FILE_HEADER])
