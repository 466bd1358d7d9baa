"""Fixed values of the transfer, each the same as in the systems it connects."""

# Test persons, left out everywhere.
TEST_CLIENTS = (5, 4216)
COMBINED_TEST_CLIENT = 243321

# Default target agencies.
DEFAULT_AGENCY = 299
COUNTY_AGENCY = 300

# Screening: legacy question code to import column.
SCREENING_QUESTIONS = {
    "IFYESDATEOFCONTACTWIT_1": "c_covid19_investigated_contact_date",
    "COHCOV19CONTACTPERSON_1": "c_covid19_contact_with_confirmed",
    "IFYESDATEOFCONTACTWIT": "c_covid19_confirmed_contact_date",
    "COHCOV19NONCONFIDENTI": "c_covid19_notes",
    "HASAMEDICALPROFESSION_1": "c_covid19_under_investigation",
    "COHCOV19CONTACTPERSON": "c_covid19_contact_with_investigated",
    "DATEOFDETERMINATION": "c_covid19_investigation_determination_date",
    "COHCOV19CHRONICILLNESS": "c_covid19_risk_chronic_illness",
    "COHCOV19HISTORYRESPIR": "c_covid19_risk_history_of_respiratory_illness",
    "AREYOUIMMUNOCOMPROMIS": "c_covid19_risk_immunocompromised",
    "DOYOUHAVECHRONICKIDNE": "c_covid19_risk_kidney_disease",
    "COHCOV1960OLDER": "c_covid19_risk_over_65",
    "HAVEYOUSMOKEDTOBACCOI": "c_covid19_risk_smoker",
    "COHCOV19ASSESSMENTDATE": "c_covid19_screening_date",
    "HASAMEDICALPROFESSION": "c_covid19_tested",
    "DATEOFCOVID19DIAGNOSIS": "c_covid19_test_date",
    "COVID19TESTRESULTS": "c_covid19_test_results",
    "COHCOV19DIFFICULTYBRE": "c_symptom_breathing_difficult",
    "COHCOV19CHILLS": "c_symptom_chills",
    "DOYOUHAVECONGESTIONOR": "c_symptom_congestion",
    "COHCOV19COUGHTODAY": "c_symptom_cough",
    "DOYOUHAVEDIARRHEA": "c_symptom_diarrhea",
    "COHCOV19FEVERPASTDAY": "c_symptom_fever",
    "COHCOV19HEADACHE": "c_symptom_headache",
    "COHCOV19NEWLOSSTASTEA": "c_symptom_lost_taste_smell",
    "COHCOV19MUSCLEPAIN": "c_symptom_muscle_pain",
    "DOYOUHAVENAUSEAORVOMI": "c_symptom_nausea",
    "COHCOV19SORETHROATTOD": "c_symptom_sore_throat",
    "AREYOUFEELINGTOOWEAKT": "c_symptom_weak",
}
SCREENING_YES_NO = (
    "c_covid19_under_investigation", "c_covid19_contact_with_investigated",
    "c_covid19_contact_with_confirmed", "c_covid19_tested",
)
SCREENING_YES_NO_PREFIXES = ("c_covid19_risk", "c_symptom")
TEST_RESULTS = {"Negative": 0, "Positive": 1, "Unknown": 2}

# Vaccine doses.
DOSE_KIND = "COVID-19 Vaccine Doses"
DOSE_QUESTIONS = {
    "Client Contact Information": "c_covid19_client_contact_info",
    "COVID-19 Vaccine Manufacturer": "c_covid19_vaccine_manufacturer",
    "Date Received Vaccine Dose": "c_covid19_date_vaccine_administered",
    "Vaccine Documentation": "c_covid19_vaccine_documentation",
}
VACCINE_MAKERS = {
    "Johnson & Johnson": 1, "Moderna": 2, "Pfizer": 3,
    "Client doesn't know and data could not be obtained from other source": 4,
}
VACCINE_PROOF = {"Healthcare provider": 1, "Self-report": 2, "Vaccine card": 3}
DOSE_AGENCY_OVERRIDES = {1793: 299, 1695: 299}

# Housing offers.
OFFER_KIND = "Offers of Permanent Housing"
OFFER_QUESTIONS = {
    "Date of accept or decline": "c_offer_accept_decline_date",
    "Date of PH Intervention Offer": "offer_date",
    "Offer Accepted?": "c_offer_accepted",
    "Type of PH Intervention Offered": "c_offer_type",
}
OFFER_ACCEPTED = {"N": 0, "Y": 1}
OFFER_TYPES = {"HUD VASH": 1, "Other PH": 2, "Other RRH": 3, "SSVF RRH": 4}

# Vulnerability scores.
SCORE_KINDS = {"VI-SPDAT v2.0": 1, "VI-FSPDAT v2.0": 2, "TAY-VI-SPDAT v1.0": 3}
SCORE_QUESTION, SCORE_START_QUESTION = "GRAND TOTAL", "Start Date"

# Assessment number and name by kind.
ASSESSMENTS = {
    "screening": (178, "COVID-19 Screening Tool"),
    "doses": (195, "COVID-19 Vaccine Doses"),
    "offers": (194, "Offers of Permanent Housing"),
    "scores": (193, "ServicePoint VI-SPDAT Assessment"),
}

# Client attributes: legacy question code to import column.
CLIENT_QUESTIONS = {
    "PERMANENTHOUSINGTRACK": "c_ph_track",
    "EXPECTEDPERMANENTHOUS": "c_expected_ph_date",
    "WOULDTHECLIENTCONSENT": "c_covid19_consent_to_vaccine",
    "IFNOTWHATARETHECONCER": "c_covid19_vaccine_concerns",
    "HOMESID": "c_homes_id",
    "LISTSTATUS": "c_list_status",
    "SSVFINELIGIBLE": "c_ssvf_ineligible",
    "VAELIGIBLE": "c_va_eligible",
    "DATEVETERANIDENTIFIED": "c_date_veteran_identified",
}
CLIENT_DATES = ("c_expected_ph_date", "c_date_veteran_identified")

# Answer lists: label to code.
ANSWER_LISTS = {
    "c_ph_track": {
        "None": 0, "HUD - VASH": 1, "PH": 2, "PSH": 3, "RRH": 4, "Self Resolve": 5, "SSVF-RRH": 6,
    },
    "c_covid19_consent_to_vaccine": {
        "No (HUD)": 0, "Yes (HUD)": 1, "Client doesn't know (HUD)": 8, "Client refused (HUD)": 9,
        "Data not collected (HUD)": 99,
    },
    "c_list_status": {
        "Active - ES/TH": 1, "Active - Unsheltered": 2, "Inactive (Non-Permanent Housing)": 3,
        "Inactive (Permanently Housed)": 4, "Inactive (Uknown/Missing)": 5,
    },
    "c_ssvf_ineligible": {"Max TFA": 1, "Not VA eligible": 2, "Over income": 3},
    "c_va_eligible": {
        "VA eligibility unknown": 1, "Veteran eligible for all VA homeless services": 2,
        "Veteran eligible for SSVF/GPD only": 3, "Veteran not eligible for VA services": 4,
    },
}

# Agencies set by hand for notes and files, by legacy program.
NOTE_AGENCY_OVERRIDES = {
    12: 9, 220: 58, 417: 84, 590: 163, 592: 91, 594: 28, 855: 99, 865: 299, 1139: 134,
    1316: 9, 1355: 4, 1775: 299, 1808: 299,
}
FILE_AGENCY_OVERRIDES = {6: 4, 8: 6, 12: 9, 862: 101, 1139: 134, 1316: 9, 1355: 4, 1366: 8, 1695: 211}
IMPORT_CATEGORY = 13

# Names and parents corrected by hand.
PROJECT_NAME_OVERRIDES = {
    85: "Columbiana - Family Recovery Center - Fleming House - TH",
    416: "zzScioto - Counseling Center - Transitional Living - TH",
}
AGENCY_NAME_OVERRIDES = {
    2999: "COORDINATED ENTRY - BoSCoC (OH-507)",
    3000: "COORDINATED ENTRY - MCHCOC (OH-504)",
}

# Services: program type to service codes that are transferred.
SERVICE_RULES = {
    "Homelessness Prevention (HUD)": (
        "PH-1000", "BH-3800.7000", "BH-3800.7250", "BV-8900.9150", "BV-8900.9300",
    ),
    "PH - Rapid Re-Housing (HUD)": (
        "PH-1000", "BH-3800.7000", "BH-3800.7250", "BV-8900.9150", "BV-8900.9300",
        "BH-3800.5150", "BH-1800.8500-300",
    ),
    "Other (HUD)": ("BH-3800.7000", "BH-3800.7250", "BV-8900.9150", "BV-8900.9300"),
    "Emergency Shelter (HUD)": ("BH-1800.8500-300",),
}
FEDERAL_SERVICE_COLUMNS = (
    "hopwa_service_type", "path_service_type", "rhy_service_type", "ssvf_service_type",
    "ssvf_fin_assist_type",
)
# Service code, legacy description, target item name.
SERVICE_TRANSLATOR = (
    ("PH-1000", "Case/Care Management", "Case Management"),
    ("BH-3800.7000", "Rent Payment Assistance", "Rental Assistance"),
    ("BH-3800.7250", "Rental Deposit Assistance", "Security Deposit"),
    ("BV-8900.9300", "Utility Service Payment Assistance", "Utility Payments"),
    ("BV-8900.9150", "Utility Deposit Assistance", "Utility Deposit"),
    ("BH-1800.8500-300", "Homeless Motel Vouchers", "Motel and Hotel Vouchers"),
    ("BH-3800.5150", "Moving Expense Assistance", "Moving Cost Assistance"),
)
ITEM_SPELLINGS = {
    "Case Management": ("Case management", "Case management services"),
    "Moving Cost Assistance": ("Moving costs",),
    "Utility Payments": ("Utility payments",),
    "Security Deposit": ("Security deposit", "Security deposits"),
    "Utility Deposit": ("Utility deposit", "Utility deposits"),
}
INTEGRATED_PROGRAMS = ("SSVF", "YHDP", "RHY", "ODH")
FUND_ACTIONS = ("Modified", "Submitted")
FUND_SOURCE_SKIPPED = "Diversion"
NON_FEDERAL_FUNDER = 46

# Non-federal funders: label to number.
OTHER_FUNDERS = {
    "Bezos Day One": 1, "CDBG": 2, "church": 3, "community": 4, "ODH": 5, "ODSA": 6, "OHFA": 7,
    "Ohio Department of Health- Youth Initiative": 8, "OSDA": 9, "Pandemic Emergency Fund": 10,
    "TANF": 11, "Unknown": 12, "CSBG": 13, "Local": 14, "OHFA ERA": 15,
    "OVW Transitional Housing": 16, "United Way": 17, "COVID-19 Deconcentration": 18,
    "Risk Mitigation": 19,
}
FUNDER_SPELLINGS = {"community": ("Community",)}
PROGRAM_FUNDER_SPELLINGS = {"community": ("Community",), "Unknown": ("unknown",)}
PROGRAM_FUNDERS_KNOWN = 17

# Funder numbers to buckets, projects whose bucket is set by hand, buckets that are merged.
PROJECT_BUCKETS = {550: "GPD/HCHV", 780: "GPD/HCHV", 2369: "GPD/HCHV", 2126: "YHDP", 2342: "RHY", 2446: "RHY"}
FUNDER_BUCKETS = {
    "CoC": (1, 2, 3, 4, 5, 6, 7, 44, 49),
    "ESG": (8, 9, 10, 11, 47),
    "RHY": (22, 23, 24, 25, 26),
    "PATH": (21,),
    "HOPWA": (13, 14, 15, 16, 17, 18, 19, 48),
    "VASH": (20,),
    "YHDP": (43,),
    "SSVF": (33,),
    "GPD/HCHV": (27, 37, 38, 39, 40, 41, 42, 45),
}
OTHER_FUNDER_BUCKETS = {
    "ODSA": "ESG", "ODH": "ODH", "Ohio Department of Health- Youth Initiative": "ODH",
}
MERGED_BUCKETS = {"CoC/ESG": ("Other", "CoC", "ESG")}
BUCKET_TEMPLATES = {
    "SSVF": 21, "YHDP": 24, "PATH": 18, "VASH": 22, "ODH": 26, "GPD/HCHV": 23, "RHY": 19, "HOPWA": 20,
}
TEMPLATE_COORDINATED, TEMPLATE_PREVENTION, TEMPLATE_HOUSING = 27, 25, 15

# Addresses: a masked one and its replacement; area codes; one county outside the state.
ADDRESS_FIXES = {
    "Address1": {"440 W. Nyack Rd.": "966 Main St"},
    "City": {"West Nyack": "Columbus"},
    "State": {"NY": "OH"},
    "ZIP": {"10994": "43205"},
}
AREA_CODES = ("OH-504", "OH-507")
AREA_COUNTY = "Mahoning"
OUT_OF_STATE_AGENCY, OUT_OF_STATE_GEOCODE = 2455, "429003"

# Columns of the combined assessments that hold days.
ASSESSMENT_DATES = (
    "c_covid19_investigated_contact_date", "c_covid19_investigation_determination_date", "c_covid19_test_date",
    "c_covid19_confirmed_contact_date", "c_offer_accept_decline_date",
)

# Users.
ADMIN_USERS = (641, 835, 1041, 1545, 1624, 2169)
SYSTEM_AGENCY = 1695

# Access points.
ACCESS_TYPE = "Coordinated Entry (HUD)"
ACCESS_SERVICES = {
    "FT-1000.9000": ("veteran_service_area", False),
    "RP-1400.8000-750": ("youth_service_area", True),
    "BH-1800.1500-100": ("dv_service_area", True),
}

# Organisations.
SPECIAL_PROJECT_WORD = "VASH"
SPECIAL_TYPE_EXEMPT = (213, 1989, 2025, 2041, 2044)
OBSOLETE_TYPES = (
    "Family Homelessness Prevention Pilot (FHPP)", "RETIRED (HUD)", "Homelessness Prevention",
    "Housing Stability Program (HSP)", "Direct Housing",
)
NO_DATA_DAY, LAST_OLD_EXIT = "2004-01-01", "2014-05-01"
OUTSIDE_STATE = "--Outside of Ohio--"
