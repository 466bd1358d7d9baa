"""Transfer jobs on invented records."""

import datetime as dt


from recordbridge.functions import dates
from recordbridge.operators import joins
from recordbridge.plans import assessments, clients, cohort, extract, fixed, helpers, import_tables, notes, services

D, TS = dt.date, dt.datetime
AS_OF = "2021-06-07"


def test_cohort(make, rows):
    entries = make(
        "client_id long, provider_id long, exit_date timestamp, active boolean",
        (1, 10, None, True), (1, 10, TS(2014, 5, 31), True), (2, 10, TS(2014, 6, 1), True), (3, 10, TS(2014, 5, 31), True),
        (4, 99, None, True), (5, 10, None, True), (6, 10, None, False), (7, 10, None, True),
    )
    people = make("client_id long, active boolean", (1, True), (7, False))
    out = cohort.client_cohort(entries, make("Legacy_ProgramID long", (10,), (10,)), people)
    assert rows(out) == [(1,), (2,)]


def test_move_in(make, rows):
    old, new = D(2017, 9, 30), D(2017, 10, 1)
    enrollment = make(
        "EnrollmentID long, ProjectID long, HouseholdID string, EntryDate date, MoveInDate date, DateOfEngagement date, Tail int",
        (1, 3, "a", old, None, None, 0), (2, 3, "b", new, new, None, 0), (3, 3, "c", new, D(2018, 1, 1), None, 0),
        (4, 13, "d", new, D(2018, 1, 1), None, 0), (5, 1, "e", new, new, None, 0), (6, 1, "b", D(2017, 12, 1), None, None, 0),
        (7, 9, "f", new, D(2017, 9, 1), None, 0), (8, 1, "d", new, None, None, 0),
    )
    exits = make("EnrollmentID long, ExitDate date", (3, D(2018, 1, 1)), (4, D(2018, 1, 1)), (8, D(2017, 12, 31)))
    project = make("ProjectID long, ProjectType int", (3, 3), (9, 9), (13, 13), (1, 1))
    out = extract.household_move_in(enrollment, exits, project, dates.day(AS_OF))
    assert out.columns == ["EnrollmentID", "ProjectID", "HouseholdID", "EntryDate", "DateOfEngagement", "MoveInDate", "Tail"]
    got = {r["EnrollmentID"]: r["MoveInDate"] for r in out.collect()}
    assert got == {1: old, 2: new, 3: None, 4: D(2018, 1, 1), 5: None, 6: D(2017, 12, 1), 7: None, 8: None}


def test_names(make, rows):
    project = make("ProjectID long, OrganizationID long, ProjectName string, ProjectCommonName string, Tail int", (1, 9, "x", "y", 0), (2, 9, "x", "y", 0))
    org = make("OrganizationID long, OrganizationName string", (9, "old"))
    names = make("ProjectID long, ProjectName string, ProjectAKA string", (1, "One", "1"), (9, "Nine", None))
    projects, orgs = extract.hud_names(project, org, names)
    assert rows(projects) == [(1, 9, "One", "1", 0), (2, 9, None, None, 0)] and rows(orgs) == [(9, "Nine")]


def test_screening_loses_earlier_answers(make):
    t0, t1 = TS(2021, 1, 1, 8), TS(2021, 1, 1, 9)
    answers = make(
        "client_id long, question_code string, val string, date_effective timestamp, provider_id long, user_id long, active boolean",
        (1, "COHCOV19CHILLS", "Y", t0, 10, 5, True), (1, "COHCOV19HEADACHE", "N", t1, 10, 5, True), (1, "COVID19TESTRESULTS", "Unknown", t1, 10, 5, True),
        (1, "COHCOV19HEADACHE", "Y", t1, 11, 5, True), (1, "OTHER", "Y", t1, 10, 5, True), (1, "COHCOV19CHILLS", "Y", t1, 10, 5, False),
        (2, "COHCOV19CHILLS", "Y", t1, 10, 5, True), (1, "COHCOV19ASSESSMENTDATE", "2020-12-30 00:00:00", t1, 10, 5, True),
    )
    crosswalk = make("Legacy_ProgramID long, Target_AgencyID int", (10, 77))
    out = assessments.covid_screening(answers, make("client_id long", (1,)), crosswalk).orderBy("AgencyID").collect()
    assert len(out) == 2 and len(out[0]) == 8 + len(fixed.SCREENING_QUESTIONS)
    first, second = out
    assert (first["assessment_date"], second["assessment_date"]) == ("2020-12-30", None)
    assert (first["AgencyID"], first["c_symptom_chills"], first["c_symptom_headache"], first["c_covid19_test_results"]) == (77, None, 0, 2)
    assert (second["AgencyID"], second["c_symptom_headache"], second["InformationDate"]) == (299, 1, "2021-01-01")
    assert sorted(r["AssessmentCustomID"] for r in out) == [1, 2]


RECORDSET = "recordset_id long, client_id long, question string, active boolean, date_added timestamp, date_effective timestamp, provider_creating_id long, user_creating_id long"
ANSWER = "recordset_id long, question string, val string, active boolean, date_added timestamp, provider_creating_id long, user_creating_id long"
T0, T1 = TS(2021, 1, 1), TS(2021, 1, 2)


def test_doses_split_by_user_and_scores_by_start_date(make, rows):
    subs = make(
        RECORDSET, (1, 1, fixed.DOSE_KIND, True, T0, T0, 10, 1), (2, 1, fixed.DOSE_KIND, True, T0, T0, 1793, 1), (3, 9, fixed.DOSE_KIND, True, T0, T0, 10, 1),
        (4, 1, "VI-SPDAT v2.0", True, T0, T0, 10, 1), (5, 1, "VI-SPDAT v2.0", True, T1, T0, 20, 1), (6, 1, "VI-SPDAT v2.0", True, T1, T0, 10, 1),
    )
    given = make(
        ANSWER, (1, "COVID-19 Vaccine Manufacturer", "Pfizer", True, T0, 1, 1), (1, "COVID-19 Vaccine Manufacturer", "Moderna", True, T1, 1, 1),
        (1, "Vaccine Documentation", "Self-report", True, T0, 1, 2), (4, "Start Date", "2021-03-01", True, T0, 1, 1), (5, "Start Date", "2021-03-01", True, T0, 1, 1),
        (6, "Start Date", "soon", True, T0, 1, 1), (4, "GRAND TOTAL", "4", True, T0, 1, 1), (5, "GRAND TOTAL", "5", True, T0, 1, 1), (5, "GRAND TOTAL", "7", True, T1, 1, 1), (6, "GRAND TOTAL", "6", True, T0, 1, 1),
    )
    people = make("client_id long", (1,))
    providers = make("provider_id long, hud_organization_id long", (10, 100), (1793, 100))
    crosswalk = make("Legacy_AgencyID long, Target_AgencyID int, Legacy_ProgramID long, Legacy_ProgramName string", (100, 55, 10, "Ten"), (100, 55, 20, "Twenty"))
    doses = assessments.vaccine_doses(subs, given, people, providers, crosswalk)
    got = rows(doses.select("PersonalID", "AgencyID", "c_covid19_vaccine_manufacturer", "c_covid19_vaccine_documentation"))
    assert got == sorted([(1, 55, 2, None), (1, 55, None, 2), (1, 299, None, None)], key=repr)
    scores = assessments.vulnerability_scores(subs, given, people, crosswalk, make("provider_id long", (20,)))
    assert rows(scores.select("AgencyID", "InformationDate", "c_vispdat_type", "c_vispdat_program_name", "c_vispdat_score")) == [(300, "2021-03-01", 1, "Twenty", "7")]
    both = assessments.combined_assessments(doses, scores, order=["AssessmentID", "PersonalID", "c_covid19_vaccine_manufacturer", "c_covid19_vaccine_documentation"])
    assert both.count() == 4 and sorted(r[0] for r in both.select("AssessmentCustomID").collect()) == [1, 2, 3, 4]
    assert assessments.missing_columns(doses) == ["UserID"]


def test_offers(make, rows):
    subs = make(RECORDSET, (1, 1, fixed.OFFER_KIND, True, T0, T0, 10, 1))
    given = make(ANSWER, (1, "Date of PH Intervention Offer", "later", True, T0, 1, 1), (1, "Offer Accepted?", "Y", True, T0, 1, 1), (1, "Type of PH Intervention Offered", "HUD VASH", True, T0, 1, 1), (1, "Date of accept or decline", "2021-02-01 00:00:00", True, T0, 1, 1))
    providers, crosswalk = make("provider_id long, hud_organization_id long", (11, 1)), make("Legacy_AgencyID long, Target_AgencyID int", (1, 55))
    out = assessments.housing_offers(subs, given, make("client_id long", (1,)), providers, crosswalk)
    assert rows(out) == [(1, 194, fixed.OFFER_KIND, 1, 299, "2021-01-01", "2021-01-01", 1, 1, "2021-02-01")]


def test_client_custom(make, rows):
    answers = make(
        "client_id long, question_code string, val string, date_effective timestamp, date_added timestamp, active boolean",
        (1, "LISTSTATUS", "Active - ES/TH", T0, T0, True), (1, "LISTSTATUS", "Active - Unsheltered", T0, T1, True), (1, "DATEVETERANIDENTIFIED", "2020-02-03 00:00:00", T0, T0, True),
        (1, "VAELIGIBLE", "unheard of", T0, T0, True), (2, "HOMESID", "h", T0, T0, True),
    )
    out = clients.client_custom(answers, make("client_id long", (1,)), dates.day(AS_OF)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["ClientCustomID"], r["ExportID"], r["c_list_status"], r["c_va_eligible"], r["c_date_veteran_identified"]) == (1, 20210607, 2, None, "2020-02-03")


def test_files_have_one_owner(make, rows):
    files = make(
        "server_filename string, client_id long, provider_creating_id long, user_creating_id long, file_name string, active boolean, date_added timestamp, date_created timestamp, date_updated timestamp",
        ("f", 2, 20, 1, "x", True, T0, T0, T1), ("f", 1, 1695, 1, "x", True, T0, T0, T1), ("g", 1, 99, 1, "y", True, T0, T0, T1), ("h", 1, 20, 1, "z", True, TS(2014, 5, 31), T0, T1),
    )
    out = clients.client_files(files, make("client_id long", (1,), (2,)), make("Legacy_ProgramID long, Target_AgencyID int", (20, 7)), dates.day(AS_OF))
    assert rows(out.select("FileID", "PersonalID", "AgencyID", "OtherName")) == [("f", 1, 211, "x")]


def test_notes(make, rows):
    note = "client_id long, note string, note_date timestamp, provider_id long, active boolean, date_added timestamp, date_updated timestamp"
    goals = make(note, (1, "a\r\nb", T0, 10, True, T0, T1), (1, None, T0, 10, True, T0, T1), (2, "c", T0, 10, True, T0, T1), (1, "d", T0, 1139, True, T0, T1), (1, "e", T0, 98, True, T0, T1))
    needs = make("client_id long, provider_id string, note string, status string, outcome string, reason_unmet string, date_set timestamp, active boolean, date_added timestamp, date_updated timestamp",
                 (1, "10", "help", "Open", None, "none", T0, True, T0, T1), (1, "10", None, "Open", None, "none", T0, True, T0, T1))
    projects = make("Legacy_ProgramID long, Legacy_ProgramName string, Target_AgencyID int", (10, "Ten", 5))
    all_rows = notes.note_rows(make("client_id long", (1,)), projects, goals=goals, needs=needs)
    out = notes.all_notes(all_rows, projects)
    assert sorted((r["AgencyID"], r["Note"]) for r in out.collect()) == [(5, "Note: help Status: Open Outcome: NA Reason Unmet: none"), (5, "a b"), (134, "d")]
    lost = notes.notes_missing_agency(all_rows, projects, make("provider_id long, name string", (98, "Lost")))
    assert rows(lost) == [(98, 1, "Lost")]


def test_services_to_funds(make, rows):
    entry = D(2020, 1, 1)
    need = make(
        "need_service_id long, need_service_group_id long, client_id long, provide_provider_id long, provide_start_date date, code string, active boolean, user_creating_id long, date_added timestamp, date_updated timestamp, path_service_type string",
        (1, 1, 1, 10, entry, "PH-1000", True, 1, T0, T0, None), (2, 1, 1, 10, D(2020, 2, 1), "PH-1000", True, 1, T0, T0, None), (3, 1, 1, 10, D(2019, 12, 31), "PH-1000", True, 1, T0, T0, None),
        (4, 1, 1, 20, D(2020, 1, 15), "BH-1800.8500-300", True, 1, T0, T0, None), (5, 1, 1, 20, D(2020, 1, 15), "PH-1000", True, 1, T0, T0, None), (6, 1, 1, 10, entry, "PH-1000", True, 1, T0, T0, "x"),
    )
    providers = make("provider_id long, program_type_code string", (10, "Homelessness Prevention (HUD)"), (20, "Emergency Shelter (HUD)"))
    kept = services.cohort_services(need, providers, make("client_id long", (1,)), empty=["path_service_type"])
    assert sorted(r["need_service_id"] for r in kept.collect()) == [1, 2, 3, 4]
    spans = make("entry_exit_id long, client_id long, provider_id long, entry_date date, exit_date date, active boolean",
                 (100, 1, 10, entry, D(2020, 2, 1), True), (101, 1, 10, D(2020, 2, 1), None, True), (102, 1, 20, entry, None, True))
    crosswalk = make("Legacy_ProgramID long, Legacy_ProgramName string, Target_AgencyID int, Target_ProgramID long, Target_ProgramName string", (10, "Ten", 5, 50, "Ten"), (20, "Twenty SSVF", 6, 60, "Twenty SSVF"))
    connected = services.connected_services(kept, crosswalk, spans, dates.day(AS_OF))
    assert rows(connected.select("ServicesID", "EnrollmentID")) == [(1, 100), (2, 100), (2, 101), (4, 102)]
    items = services.service_items(make("Target_ProgramID long, Target_ProgramName string, ServiceItemID long, ServiceItemName string", (50, "Ten", 7, "Case management")))
    translator = make("sp_code string, sp_desc string, item_desc string", *fixed.SERVICE_TRANSLATOR)
    done = services.translated_services(connected, items, translator)
    assert rows(done.select("ServicesID", "EnrollmentID", "ServiceItemID")) == [(1, 100, 7), (2, 100, 7), (2, 101, 7), (4, 102, None)]
    assert services.services_not_connecting(done).count() == 0 and services.services_not_coming(done).count() == 1
    funds = make("need_service_group_id long, cost int, source string, last_action string, active boolean, date_added timestamp", (1, 9, "City", "Modified", True, T0), (1, 9, "Diversion", "Modified", True, T0))
    amounts = services.fund_amounts(funds)
    changes = make("Target_ProgramID long, Target_ProgramName string, source string, NewSource string", (50, "Ten", "City", "Town"))
    fund_codes = make("source string, funding_source int, funding_source_other int, FundingSource string", ("Town", 46, None, "Local"))
    target = make("Target_ProgramID long, FundingSourceID int, FundingOtherID int, FundingOther string, Active string, TargetFundingSourceID long", (50, 46, None, "t", "Yes", 31), (50, 46, None, "t", "Yes", 30), (50, 46, None, "t", "No", 29))
    funded = services.funded_services(done, amounts, changes, fund_codes, target)
    out = services.custom_services(funded)
    assert {(r["ServicesID"], r["EnrollmentID"], r["FundingSourceID"], r["FAAmount"]) for r in out.collect()} == {(1, 100, 30, 9), (2, 100, 30, 9), (3, 101, 30, 9)}
    assert services.missing_funding(funded).count() == 0


ADDRESSES = "ProjectID long, ProjectName string, ProjectAKA string, OrganizationName string, Address1 string, Address2 string, City string, State string, ProjectCounty string, ZIP string"


def addresses(make):
    return import_tables.fixed_addresses(make(
        ADDRESSES,
        (2, "Agency Two", None, "Two(2)(x)", "440 W. Nyack Rd.", None, "West Nyack", "NY", "Franklin", "10994"), (2455, "Away", None, "Away", None, None, None, None, None, None),
        (20, "House", "H", "Two(2)", "1 Side St", "Apt 2", "Dover", "OH", "Mahoning", "44622-1234"), (21, "Home", None, "Two(2)", "1 Side St", "Apt 2", "Dover", "OH", "Mahoning", "44622-1234"),
        (22, "Barn", None, "Two(2)", "2 Side St", None, "Dover", "OH", None, "44622-1234"), (23, "Flat", None, "Two(2)", "966 Main St", None, "Columbus", "OH", "Franklin", "43205"),
    ))


def test_agencies_and_sites(make, rows):
    org = make("OrganizationID long, OrganizationName string, VictimServicesProvider int, DateCreated timestamp, DateUpdated timestamp", (1, "Root", 0, T0, T1), (2, "Agency Two", 0, T0, T1), (2455, "Away", 1, T0, T1), (3, None, 0, T0, T1))
    geocodes = make("Geocode string, Name string", ("390001", "Columbus"), ("390002", "Franklin County"), ("390003", "Mahoning County"))
    project = make("ProjectID long, OrganizationID long", (20, 2), (21, 2))
    coc = make("ProjectID long, CoCCode string", (20, "OH-504"), (21, "OH-507"), (21, "OH-999"))
    counties = make("ID int, ProjectCounty string", (25, "Franklin County"))
    table = import_tables.agencies(org, addresses(make), counties, geocodes, project, coc)
    got = {r["id"]: r for r in table.collect()}
    assert set(got) == {2, 2455} and table.columns[0] == "id" and table.columns[-1] == "send_referral_notifications"
    two, away = got[2], got[2455]
    assert (two["default_site_name"], two["geolocations__geocode"], two["counties__id"], two["coc"], two["geolocations__zipcode"]) == ("966 Main St", "390001", 25, "OH-507", "43205")
    assert (away["default_site_name"], away["geolocations__geocode"], away["counties__id"], away["coc"]) == ("Confidential - Away", "429003", 0, None)
    assert rows(import_tables.missing_addresses(table).select("id")) == [(2455,)]
    assert "geolocations.city" in import_tables.import_names(table).columns

    owners = make("ProjectID long, ProjectName string, AgencyID long, AgencyName string", (20, "House", 2, "Agency Two"), (21, "Home", 2, "Agency Two"), (22, "Barn", 77, "Other"), (23, "Flat", 2, "Agency Two"))
    phones = make("ProjectID string, ProjectTelPrimary string, ProjectTelNo string", ("2", "Yes", "555"), ("2", "No", "556"))
    out = import_tables.sites(make("id long", (2,), (2455,)), addresses(make), owners, geocodes, phones, dates.day(AS_OF))
    assert rows(out.select("id", "ref_agency", "name", "geolocations__geocode", "coc", "phone", "information_date")) == [(1, 2, "1 Side St Apt 2", "390003", "OH-504", "555", AS_OF)]
    shared = import_tables.shared_addresses(addresses(make))
    assert rows(shared.select("Address1", "ProjectCount", "ProjectIDs")) == [("1 Side St", 2, "20, 21"), ("2 Side St", 1, "22")]


FUNDER = "FunderID long, ProjectID long, Funder int, OtherFunder string, GrantID string, StartDate date, EndDate date, DateCreated timestamp, DateUpdated timestamp"


def funders(make):
    past, later = D(2020, 1, 1), D(2022, 1, 1)
    return make(
        FUNDER, (1, 20, 2, None, "0", past, None, T0, T1), (2, 20, 46, "ODH", "g", past, later, T0, T1), (3, 20, 46, "Community", None, past, past, T0, T1), (4, 20, 8, None, "g", past, past, T0, T1), (5, 21, 33, None, "g", past, past, T0, T1),
        (6, 550, 2, None, "g", past, past, T0, T1), (7, 22, 99, None, "g", past, past, T0, T1),
    )


def test_funding_and_programs(make, rows):
    specs = make("DataElement string, ReferenceNo string, Description string", ("FundingSource", "2", "CoC"), ("FundingSource", "x", "bad"), ("Other", "46", "no"))
    owners = make("ProjectID long, ProjectName string, AgencyID long, AgencyName string", (20, "House", 2, "Two"))
    out = import_tables.funding_sources(funders(make), specs, owners, dates.day(AS_OF)).orderBy("id").collect()
    assert [(r["name"], r["status"], r["funding_source_non_federal"], r["grant_identifier"]) for r in out[:4]] == [("House: CoC", 1, None, "N/A"), ("House: NA", 1, 5, "g"), ("House: NA", 0, 4, None), ("House: NA", 0, None, "g")]
    assert out[4]["name"] == "NA: NA"
    assert rows(import_tables.funder_buckets(funders(make))) == [(20, "CoC/ESG"), (20, "ODH"), (21, "SSVF"), (22, "CoC/ESG"), (550, "GPD/HCHV")]
    wide = {r["ProjectID"]: r for r in import_tables.funder_columns(funders(make)).collect()}
    assert [wide[20][f"funding_source_{i}"] for i in (1, 2, 3)] == [2, 46, 46] and wide[20]["funding_source_non_federal_3"] == 4

    project = make("ProjectID long, OrganizationID long, OperatingStartDate date, OperatingEndDate date, ContinuumProject int, ProjectType int, HousingType int, ResidentialAffiliation int, TrackingMethod int, HMISParticipatingProject int, TargetPopulation int",
                   (20, 2, None, None, 1, 3, None, None, 0, 1, None), (21, 2, None, None, 1, 6, 2, 1, 0, 1, 3), (22, 2, None, None, 1, 12, 2, 1, 0, 1, 3), (23, 99, None, None, 1, 2, 2, 1, 0, 1, 3))
    coc = make("ProjectID long, Geocode string", (20, "390001"), (20, "390001"))
    extras = addresses(make)
    table = import_tables.programs(project, coc, funders(make), extras, make("ProjectID long, Description string", (20, "d")), extras, make("id long", (2,)), dates.day(AS_OF), {21: "548, 774"})
    got = rows(table.select("id", "ref_template", "funding_source_1", "cascade_threshold", "aff_res_proj", "aff_res_proj_ids", "programs__ref_target_b", "ref_housing_type", "geocode"))
    assert got == sorted([(20, 26, 2, 365, 0, "", 4, 1, "390001"), (20, 15, 2, 365, 0, "", 4, 1, "390001"), (21, 21, 33, 30, 1, "548, 774", 3, 2, None), (22, 25, 99, 30, 0, "", 3, 2, None)], key=repr)
    assert rows(joins.fanout_report(import_tables.funder_buckets(funders(make)), ["ProjectID"])) == [(20, 2)]
    assert import_tables.service_template(project.limit(1)).first().asDict() == {c: "" for c in import_tables.SERVICE_COLUMNS}


def test_inventory(make, rows):
    kinds = "YouthVetBedInventory int, VetBedInventory int, YouthBedInventory int, OtherBedInventory int, CHVetBedInventory int, CHYouthBedInventory int, CHBedInventory int"
    inv = make(
        f"InventoryID long, ProjectID long, CoCCode string, HouseholdType int, Availability int, UnitInventory int, BedInventory int, {kinds}, ESBedType int, InventoryStartDate date, InventoryEndDate date, DateCreated timestamp, DateUpdated timestamp",
        (1, 1, "c", 1, 1, 1, 5, 1, None, None, 4, None, None, None, 1, None, None, T0, T1), (2, 1, "c", 1, 1, 1, 9, 1, None, -1, 4, None, None, None, 1, None, None, T0, T1), (3, 1, "c", 1, 1, 1, None, 1, None, None, 4, None, None, None, 1, None, None, T0, T1),
    )
    table = import_tables.program_inventory(inv)
    p = "program_inventory__"
    assert rows(table.select("id", p + "bed_non_dedicated", p + "is_bed_other_youth", p + "bed_other_veteran")) == sorted([(1, 4, 0, 0), (2, 9, 1, 0), (3, None, 0, 0)], key=repr)
    assert import_tables.inventory_not_adding_up(table).count() == 0


def test_users(make, rows):
    groups = make("UserID long, UserName string, UserEmail string, EDAGroupName string", (1, "Smith, Lindsey", "l@x", "g1"), (1, "Smith, Lindsey", "l@x", "g2"), (2, "O'Day-Lee,  Bo ", "b@x", "g1"), (641, "Admin, A", "a@x", "g1"), (3, "Nobody", "n@x", "g3"))
    projects = make("ProjectID long, EDAGroup string", (20, "g1"), (21, "g1"), (30, "g2"), (None, "g3"), (40, "g2"))
    owners = make("ProjectID long, ProjectName string, AgencyID long, AgencyName string", (20, "a", 9, "Nine"), (21, "b", 9, "Nine"), (30, "c", 8, "Eight"), (40, "d", 1695, "System"))
    renamed = make("First string, Last string, NewLast string", ("Lindsey", "Smith", "Smith2"))
    table = import_tables.users(groups, projects, owners, dates.day(AS_OF), renamed=renamed)
    got = {r["email"]: r for r in table.collect()}
    assert set(got) == {"l@x", "b@x"} and "password" not in table.columns
    lin = got["l@x"]
    assert (lin["name"], lin["members__last_name"], lin["user_agencies__ref_agency"], lin["user_agencies2"], lin["user_agencies3"], lin["user_agencies4"]) == ("lsmith2", "Smith", 8, "9", "9", "")
    assert got["b@x"]["name"] == "bodaylee"
    deduped = import_tables.users(groups, projects, owners, dates.day(AS_OF), dedupe=True)
    assert deduped.where("email = 'l@x'").first()["user_agencies3"] == ""
    assert rows(import_tables.names_without_comma(groups)) == [("Nobody",)] and import_tables.shortest_login(table).first()["length"] == 7
    assert import_tables.duplicate_logins(table).count() == 0 and import_tables.special_logins(table).count() == 0


def test_counties(make, rows):
    answers = "PersonalID long, EnrollmentID long, InformationDate int, DataCollectionStage int, CountyServed string, CountyPrior string"
    at_entry = make(answers, (1, 1, 44000, 1, "Ash", fixed.OUTSIDE_STATE), (2, 2, 44000, 1, None, "Nowhere"))
    at_exit = make(answers, (1, 1, 44001, 3, fixed.OUTSIDE_STATE, "Ash"))
    out = clients.enrollment_counties(at_entry, at_exit, make("County string, Geocode string", ("Ash", "39005")), dates.day(AS_OF))
    assert rows(out) == [(1, 1, 1, "2020-06-18", 1, 20210607, "39005", "0"), (2, 1, 1, "2020-06-19", 3, 20210607, "0", "39005"), (3, 2, 2, "2020-06-18", 1, 20210607, None, None)]


def test_organisations(make, rows):
    cols = "Org string, ProjectID long, Project string, ptc string, MinEntry date, MaxExit date, OpenEEs int, operating string, participating string"
    old = D(2014, 5, 1)
    profile = make(
        cols, ("gone", 2, "p", "x", None, old, None, "No", "No"), ("gone2", 3, "p", "x", None, None, 0, "No", "No"), ("shell", 4, "p", "x", None, D(2014, 5, 2), 0, "No", "No"), ("op", 5, "p", "x", None, None, 0, "Yes", "No"),
        ("vash", 6, "A VASH", "x", None, None, 0, "No", "No"), ("open", 7, "p", "x", None, None, 2, "No", "No"), ("exempt", 213, "p", fixed.ACCESS_TYPE, None, None, 0, "No", "No"), ("unknown", 8, "p", "x", None, None, 0, None, "No"), ("root", 1, "p", "x", None, None, 9, "Yes", "Yes"),
    )
    out = helpers.org_classify(helpers.org_profile(helpers.project_flags(profile)))
    assert dict((r["Org"], r["status"]) for r in out.collect()) == {
        "gone": "not migrating", "gone2": "not migrating", "exempt": "not migrating", "shell": "migrating inactive", "op": "migrating inactive", "unknown": "migrating inactive",
        "vash": "migrating active", "open": "migrating active",
    }
    second = make("Org string, ptc string, Project string", ("r", "Administrating Agency", "B"), ("r", "Administrating Agency", "zzC"), ("r", "Administrating Agency", "A"), ("A", "x", "y"))
    assert rows(helpers.referral_orgs(second, "r")) == [("B",)]
