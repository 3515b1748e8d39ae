"""What every view must hold, written down by hand and apart from the specs.

One block per source: area name, unit and flag columns, then the keys of the five
bags.  A key is the column of its name unless ``key=column`` says otherwise
(``@`` is the joined area code).  Fixed values.
"""

from __future__ import annotations

import pytest

from indicatorlake.plans.specs import BAGS, SPECS

EXPECTED = """
agincentives : listname_en ; - ; -
  country_code listname_en regionfaocode regionname wbcode2015 wbname2015 / year / measure nra_cat / catprod agprocode aggregation / -
fao_aquastat_irrigation : area ; unit_measure_code ; obs_status
  ref_area=@ area ref_area_iso2 ref_area_iso3 / time_period freq frequency / element_code element / - / obs_status observation_status unit_measure_code unit_measure unit_mult unit_multiplier
fao_aquastat_wateruse : area ; unit_measure_code ; obs_status
  ref_area=@ area ref_area_iso2 ref_area_iso3 / time_period freq frequency / element_code element / - / obs_status observation_status unit_measure_code unit_measure unit_mult unit_multiplier
fao_fishstat_globalproduction : area ; unit_measure ; obs_status
  ref_area=@ area / time_period freq / species species_name species_tax_family species_tax_code species_yearbook_sofia species_isscaap_division species_isscaap_group species_cpc_class species_faostat / production_source water_area water_area_inland_marine water_area_major_fishing_area fishing_area / obs_status unit_measure unit_mult
fao_fishstat_processed : area ; unit_measure ; obs_status
  ref_area=@ area / time_period freq / product aquatic_product product_yearbook_sofia product_fao_major_group product_isscaap_division product_isscaap_group product_cpc_class product_faostat_1 product_faostat_2 pproduction_element / - / obs_status unit_measure unit_mult
fao_fra_change : area ; unit_measure_code ; obs_status
  ref_area=@ area ref_area_iso2 ref_area_iso3 / time_period time_range freq frequency / variable_code variable_label / - / obs_status observation_status unit_measure_code unit_measure_label unit_mult unit_multiplier decimals_code decimals_label
faostat_ae : area ; unit ; flag
  area_code / year_code year / indicator_code indicator / cost_category_code cost_category institution_code institution / flag note unit
faostat_be : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag unit
faostat_cahd : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag unit release_code release
faostat_cp : area ; unit ; flag
  area_code / year_code year months_code months / item_code item element_code element / - / flag note unit
faostat_cs : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_ei : area ; unit ; flag
  area_code / year_code year / item_code item item_code_cpc element_code element / - / flag unit
faostat_em : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag unit
faostat_esb : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_et : area ; unit ; flag
  area_code / year_code year months_code months / element_code element / - / flag unit
faostat_fbs : area ; unit ; flag
  area_code / year_code year / item_code item item_code_fbs element_code element / - / flag note unit
faostat_fo : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_fs : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_gt : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / source_code source / flag note unit
faostat_hces : survey ; unit ; flag
  survey_code / survey_year / indicator_code indicator element_code element / geographic_level_code geographic_level food_group_code food_group / flag note unit
faostat_ig : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_mddw : survey ; unit ; flag
  survey_code / survey_year / indicator_code indicator element_code element / geographic_level_code geographic_level food_group_code food_group / flag unit
faostat_mk : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_oa : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_oea : area ; unit ; flag
  area_code / year_code year / indicator_code indicator element_code element / source_code source sex_code sex / flag note unit
faostat_oer : area ; unit ; flag
  area_code / year_code year / indicator_code indicator element_code element / source_code source sex_code sex / flag note unit
faostat_qcl : area ; unit ; flag
  area_code / year_code year / item_code item item_code_cpc element_code element / - / flag note unit
faostat_qv : area ; unit ; flag
  area_code / year_code year / item_code item item_code_cpc element_code element / - / flag unit
faostat_rfn : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_rl : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_rlis : survey ; unit ; flag
  survey_code / survey_year / indicator_code indicator element_code element / qualifier_code qualifier source_code source / flag note unit
faostat_rp : area ; unit ; flag
  area_code / year_code year / item_code item element_code element / - / flag note unit
faostat_sdgb : area ; unit ; flag
  area_code / year_code year / item_code item item_code_sdg element_code element / - / flag note unit
faostat_sua : area ; unit ; flag
  area_code / year_code year / indicator_code indicator element_code element / food_group_code food_group / flag note unit
faostat_tcl : area ; unit ; flag
  area_code / year_code year / item_code item item_code_cpc element_code element / - / flag note unit
faostat_tcli : area ; unit ; flag
  area_code / year_code year / item_code item item_code_cpc indicator_code indicator / - / flag note unit
faostat_wcad : area ; unit ; flag
  area_code / wca_round_code wca_round census_year_code census_year / item_code item element_code element / - / flag note unit
fsd : country ; unit ; -
  iso3 country region / start_year end_year / indicator / - / unit source
ilostat_emp_dwap_rt : ref_area_label ; - ; obs_status_label
  ref_area_m49code=@ ref_area_label / time / indicator_label / sex_label classif1_label classif2_label source_label / obs_status_label note_classif_label note_indicator_label note_source_label
ilostat_emp_xtru_nb : ref_area_label ; - ; obs_status_label
  ref_area_m49code=@ ref_area_label / time / indicator_label / sex_label classif1_label classif2_label source_label / obs_status_label note_classif_label note_indicator_label note_source_label
ilostat_emp_xtru_rt : ref_area_label ; - ; obs_status_label
  ref_area_m49code=@ ref_area_label / time / indicator_label / sex_label classif1_label classif2_label source_label / obs_status_label note_classif_label note_indicator_label note_source_label
scp_hat_national : country_region ; unit ; -
  ref_m49_code=@ country_region / year / indicator / - / unit
unesco_opri : country_name_english ; - ; qualifier
  country_iso_alpha_3_code country_name_english unesco_regional_group / year / indicator_id indicator_english / - / magnitude qualifier footnotes
usda : country_territory ; - ; -
  iso3 fao country_territory region sub_region inc_i order / year / variable / - / -
wb_aspire : ref_area_label ; unit_measure ; obs_status
  ref_area ref_area_label / time_period freq freq_label time_format time_format_label base_period / indicator indicator_label / sex sex_label urbanization urbanization_label program_type program_type_label beneficiary_type beneficiary_type_label income_group income_group_label pret pret_label / structure structure_id action unit_measure unit_measure_label unit_mult unit_mult_label unit_type unit_type_label decimals decimals_label agg_method agg_method_label database_id database_id_label obs_status obs_status_label obs_conf obs_conf_label
wb_es : ref_area_label ; unit_measure ; obs_status
  ref_area ref_area_label / time_period freq freq_label time_format time_format_label / indicator indicator_label / sex sex_label age age_label urbanisation urbanisation_label comp_breakdown_1 comp_breakdown_1_label comp_breakdown_2 comp_breakdown_2_label comp_breakdown_3 comp_breakdown_3_label / structure structure_id action unit_measure unit_measure_label unit_mult unit_mult_label unit_type unit_type_label agg_method agg_method_label database_id database_id_label obs_status obs_status_label obs_conf obs_conf_label
wb_wdi : country_name ; unit_of_measure ; -
  country_code country_name / wb_year_code wb_year periodicity base_period / indicator_code indicator_name topic long_definition / - / unit_of_measure other_notes aggregation_method limitations_and_exceptions source statistical_concept_and_methodology development_relevance note_country_series note_series_time note_footnote
wb_wgi : ref_area_label ; unit_measure ; obs_status
  ref_area ref_area_label / time_period freq freq_label time_format time_format_label / indicator indicator_label / sex sex_label age age_label urbanisation urbanisation_label comp_breakdown_1 comp_breakdown_1_label comp_breakdown_2 comp_breakdown_2_label comp_breakdown_3 comp_breakdown_3_label / structure structure_id action unit_measure unit_measure_label unit_mult unit_mult_label unit_type unit_type_label decimals decimals_label database_id database_id_label obs_status obs_status_label obs_conf obs_conf_label
"""


def blocks():
    lines = [line.strip() for line in EXPECTED.strip().splitlines()]
    for head, body in zip(lines[::2], lines[1::2]):
        code, rest = head.split(" : ")
        yield code, [None if c == "-" else c for c in rest.split(" ; ")], [[] if b == "-" else b.split() for b in body.split(" / ")]


TABLE = {code: (columns, bags) for code, columns, bags in blocks()}


def test_every_view_is_written_down():
    assert sorted([*TABLE, "unstats_sdg"]) == sorted(SPECS)


@pytest.mark.parametrize("code", sorted(TABLE))
def test_view(code):
    spec, (columns, bags) = SPECS[code], TABLE[code]
    unit = spec.unit if not spec.unit_when else None
    assert [spec.area_name, unit, spec.flag] == columns
    for bag, keys in zip(BAGS, bags, strict=True):
        pairs = [k.split("=") if "=" in k else [k, k] for k in keys]
        assert [(key, column) for key, column, _ in spec.entries(bag)] == [tuple(p) for p in pairs], bag
        assert not any(na for *_, na in spec.entries(bag))


def test_the_view_that_reads_na_as_missing():
    spec = SPECS["unstats_sdg"]
    plain = {"geoareacode", "timeperiod", "seriescode", "seriesid", "id", "seriesobservationcount", "observationid"}
    entries = [e for bag in BAGS for e in spec.entries(bag)]
    assert {key for key, _, na in entries if not na} == plain
    assert [len(spec.entries(bag)) for bag in BAGS] == [2, 4, 7, 56, 16]
    assert (spec.area_name, spec.unit, spec.flag, spec.na_values) == ("geoareaname", "units", "observation_status", True)
