"""What each of the 49 harmonised views reads, one entry per source.

Bag text lists JSON keys in order.  ``key=column`` reads another column,
``@`` stands for the cleaned area key, and a trailing ``~`` turns the text
``NA`` into NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

BAGS = ("GEO", "TIME_PERIOD", "SERIES", "DIMS", "ATTRS")


@dataclass(frozen=True)
class ViewSpec:
    area: str  # raw column that identifies the area
    area_name: str
    area_rule: str = "m49"  # m49, m49_plain, survey or iso3
    area_ref: str = "@"  # "@" publishes the cleaned key, "raw" the code without its apostrophe
    year: tuple[str, ...] = ("plain", "year")
    value: str = "value"
    unit: str | None = None
    unit_when: tuple[str, tuple[str, ...], str] | None = None  # column, its values, unit
    flag: str | None = None
    bags: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    measures: tuple[str, ...] = ()  # value columns to turn into (measure, value) rows
    na_values: bool = False  # area name, unit and flag write NULL as NA

    def entries(self, bag: str) -> list[tuple[str, str, bool]]:
        """(json key, column or @, NA is NULL) of one bag."""
        found = []
        for word in self.bags.get(bag, "").split():
            na = word.endswith("~")
            key, _, column = word.rstrip("~").partition("=")
            found.append((key, column or key, na))
        return found

    def raw_columns(self) -> list[str]:
        """Columns the source table must have, before renames, without the lineage columns."""
        back = {new: old for old, new in self.renames.items()}
        wanted = [self.area, self.area_name, *self.year[1:], self.value]
        wanted += [c for c in (self.unit, self.flag) if c]
        wanted += [c for b in BAGS for _, c, _ in self.entries(b) if c != "@"]
        made = {"measure", "value"} if self.measures else set()
        made |= {"survey_year"} if self.area_rule == "survey" else set()
        names = [back.get(c, c) for c in wanted if c not in made]
        return list(dict.fromkeys([*names, *self.measures]))


def _coded(names: str) -> str:
    """Code and label columns: ``item`` gives ``item_code item``."""
    return " ".join(f"{n}_code {n}" for n in names.split())


def _labelled(names: str) -> str:
    """Value and label columns: ``sex`` gives ``sex sex_label``."""
    return " ".join(f"{n} {n}_label" for n in names.split())


def _bags(geo: str, time: str, series: str, dims: str, attrs: str) -> dict[str, str]:
    return dict(zip(BAGS, (geo, time, series, dims, attrs)))


ITEM_ELEMENT = _coded("item element")


def _faostat(
    series: str = ITEM_ELEMENT,
    time: str = "year_code year",
    dims: str = "",
    attrs: str = "flag note unit",
    year: tuple[str, ...] = ("plain", "year"),
) -> ViewSpec:
    return ViewSpec(
        area="area_code_m49", area_name="area", area_ref="raw", year=year, unit="unit", flag="flag",
        bags=_bags("area_code", time, series, dims, attrs),
    )


def _classified(classification: str, measure: str = "element") -> str:
    return f"{_coded('item')} item_code_{classification} {_coded(measure)}"


def _survey(dims: str, attrs: str = "flag note unit") -> ViewSpec:
    return ViewSpec(
        area="survey_code", area_name="survey", area_rule="survey", year=("plain", "survey_year"),
        unit="unit", flag="flag",
        bags=_bags("survey_code", "survey_year", _coded("indicator element"), dims, attrs),
    )


def _world_bank(dims: str, attrs: str, base_period: str = "") -> ViewSpec:
    return ViewSpec(
        area="ref_area", area_name="ref_area_label", area_rule="iso3", year=("plain", "time_period"),
        value="obs_value", unit="unit_measure", flag="obs_status",
        bags=_bags(_labelled("ref_area"), f"time_period {_labelled('freq time_format')} {base_period}",
                   _labelled("indicator"),
                   _labelled(dims), f"structure structure_id action {_labelled(attrs)}"),
    )


# Published key and column names.
AQUASTAT = ViewSpec(
    area="ref_area", area_name="area", year=("plain", "time_period"), value="obs_value",
    unit="unit_measure_code", flag="obs_status",
    renames={"element": "element_code", "element_1": "element",
             "unit_measure": "unit_measure_code", "unit_measure_1": "unit_measure"},
    bags=_bags("ref_area=@ area ref_area_iso2 ref_area_iso3", "time_period freq frequency",
               _coded("element"), "",
               "obs_status observation_status unit_measure_code unit_measure unit_mult unit_multiplier"),
)

# Published key and column names.
FOREST_CHANGE = replace(
    AQUASTAT, year=("range_end", "time_range"),
    renames={"variable": "variable_code", "variable_1": "variable_label",
             "unit_measure": "unit_measure_code", "unit_measure_1": "unit_measure_label",
             "decimals": "decimals_code", "decimals_1": "decimals_label"},
    bags=_bags("ref_area=@ area ref_area_iso2 ref_area_iso3", "time_period time_range freq frequency",
               "variable_code variable_label", "",
               "obs_status observation_status unit_measure_code unit_measure_label "
               "unit_mult unit_multiplier decimals_code decimals_label"),
)


def _fishstat(series: str, dims: str) -> ViewSpec:
    return ViewSpec(
        area="ref_area", area_name="area", year=("plain", "time_period"), value="obs_value",
        unit="unit_measure", flag="obs_status",
        bags=_bags("ref_area=@ area", "time_period freq", series, dims, "obs_status unit_measure unit_mult"),
    )


# Published key and column names.
ILOSTAT = ViewSpec(
    area="ref_area_m49code", area_name="ref_area_label", year=("leading", "time"), value="obs_value",
    flag="obs_status_label",
    bags=_bags("ref_area_m49code=@ ref_area_label", "time", "indicator_label",
               "sex_label classif1_label classif2_label source_label",
               "obs_status_label note_classif_label note_indicator_label note_source_label"),
)

# Published key and column names.
SDG_DIMENSIONS = """
age sex location level_status name_of_international_agreement education_level type_of_product
type_of_facilities name_of_international_institution type_of_occupation tariff_regime_status
type_of_skill mode_of_transportation type_of_mobile_technology name_of_non_communicable_disease
type_of_speed migratory_status disability_status hazard_type ihr_capacity cities reporting_type
quantile activity policy_domains policy_instruments sampling_stations type_of_waste_treatment
grounds_of_discrimination parliamentary_committees cause_of_death substance_use_disorders
mountain_elevation deviation_level frequency_of_chlorophyll_a_concentration food_waste_sector
fiscal_intervention_stage level_of_requirement type_of_support report_ordinal counterpart
government_name severity_of_price_levels level_of_government type_of_renewable_technology
population_group custom_breakdown service_attribute land_cover bioclimatic_belt
illicit_financial_flows nutrient_loading type_of_ofdi_scheme marine_spatial_planning_msp
composite_breakdown type_of_household
"""

SDG = ViewSpec(
    area="geoareacode", area_name="geoareaname", area_rule="m49_plain", year=("plain", "timeperiod"),
    unit="units", flag="observation_status", na_values=True,
    bags=_bags("geoareacode=@ geoareaname~", "timeperiod time_detail~ timecoverage~ freq~",
               "goal~ target~ indicator~ seriescode seriesid seriesdescription~ isdsdseries~",
               " ".join(f"{name}~" for name in SDG_DIMENSIONS.split()),
               "id units~ unitmultiplier~ nature~ seriesobservationcount releasestatus~ releasename~ "
               "valuetype~ upperbound~ lowerbound~ baseperiod~ source~ geoinfourl~ footnote~ "
               "observationid observation_status~"),
)

# Published key and column names.
AGINCENTIVES = ViewSpec(
    area="country_code", area_name="listname_en", area_rule="iso3",
    measures=("support_usd", "relevantvalueproduction", "nra"),
    unit_when=("measure", ("support_usd", "relevantvalueproduction"), "USD"),
    bags=_bags("country_code listname_en regionfaocode regionname wbcode2015 wbname2015", "year",
               "measure nra_cat", "catprod agprocode aggregation", ""),
)

# One entry per source code; column and key names are the published ones.
SPECS: dict[str, ViewSpec] = {
    "agincentives": AGINCENTIVES,
    "fao_aquastat_irrigation": AQUASTAT,
    "fao_aquastat_wateruse": AQUASTAT,
    "fao_fishstat_globalproduction": _fishstat(
        "species species_name species_tax_family species_tax_code species_yearbook_sofia "
        "species_isscaap_division species_isscaap_group species_cpc_class species_faostat",
        "production_source water_area water_area_inland_marine water_area_major_fishing_area fishing_area"),
    "fao_fishstat_processed": _fishstat(
        "product aquatic_product product_yearbook_sofia product_fao_major_group "
        "product_isscaap_division product_isscaap_group product_cpc_class product_faostat_1 "
        "product_faostat_2 pproduction_element", ""),
    "fao_fra_change": FOREST_CHANGE,
    "faostat_ae": _faostat(series=_coded("indicator"), dims=_coded("cost_category institution")),
    "faostat_be": _faostat(attrs="flag unit"),
    "faostat_cahd": _faostat(attrs=f"flag unit {_coded('release')}"),
    "faostat_cp": _faostat(time="year_code year months_code months"),
    "faostat_cs": _faostat(),
    "faostat_ei": _faostat(series=_classified("cpc"), attrs="flag unit"),
    "faostat_em": _faostat(attrs="flag unit"),
    "faostat_esb": _faostat(),
    "faostat_et": _faostat(time="year_code year months_code months", series=_coded("element"),
                           attrs="flag unit"),
    "faostat_fbs": _faostat(series=_classified("fbs")),
    "faostat_fo": _faostat(),
    "faostat_fs": _faostat(year=("last_four", "year_code")),
    "faostat_gt": _faostat(dims=_coded("source")),
    "faostat_hces": _survey(_coded("geographic_level food_group")),
    "faostat_ig": _faostat(),
    "faostat_mddw": _survey(_coded("geographic_level food_group"), attrs="flag unit"),
    "faostat_mk": _faostat(),
    "faostat_oa": _faostat(),
    "faostat_oea": _faostat(series=_coded("indicator element"), dims=_coded("source sex")),
    "faostat_oer": _faostat(series=_coded("indicator element"), dims=_coded("source sex")),
    "faostat_qcl": _faostat(series=_classified("cpc")),
    "faostat_qv": _faostat(series=_classified("cpc"), attrs="flag unit"),
    "faostat_rfn": _faostat(),
    "faostat_rl": _faostat(),
    "faostat_rlis": _survey(_coded("qualifier source")),
    "faostat_rp": _faostat(),
    "faostat_sdgb": _faostat(series=_classified("sdg")),
    "faostat_sua": _faostat(series=_coded("indicator element"), dims=_coded("food_group")),
    "faostat_tcl": _faostat(series=_classified("cpc")),
    "faostat_tcli": _faostat(series=_classified("cpc", "indicator")),
    "faostat_wcad": _faostat(time=_coded("wca_round census_year"), year=("census", "census_year_code")),
    "fsd": ViewSpec(
        area="iso3", area_name="country", area_rule="iso3",
        year=("end_or_start", "end_year", "start_year"), unit="unit",
        bags=_bags("iso3 country region", "start_year end_year", "indicator", "", "unit source")),
    "ilostat_emp_dwap_rt": ILOSTAT,
    "ilostat_emp_xtru_nb": ILOSTAT,
    "ilostat_emp_xtru_rt": ILOSTAT,
    "scp_hat_national": ViewSpec(
        area="ref_m49_code", area_name="country_region", unit="unit",
        bags=_bags("ref_m49_code=@ country_region", "year", "indicator", "", "unit")),
    "unesco_opri": ViewSpec(
        area="country_iso_alpha_3_code", area_name="country_name_english", area_rule="iso3",
        flag="qualifier",
        bags=_bags("country_iso_alpha_3_code country_name_english unesco_regional_group", "year",
                   "indicator_id indicator_english", "", "magnitude qualifier footnotes")),
    "unstats_sdg": SDG,
    "usda": ViewSpec(
        area="iso3", area_name="country_territory", area_rule="iso3",
        bags=_bags("iso3 fao country_territory region sub_region inc_i order", "year", "variable", "", "")),
    "wb_aspire": _world_bank(
        base_period="base_period",
        dims="sex urbanization program_type beneficiary_type income_group pret",
        attrs="unit_measure unit_mult unit_type decimals agg_method database_id obs_status obs_conf"),
    "wb_es": _world_bank(
        dims="sex age urbanisation comp_breakdown_1 comp_breakdown_2 comp_breakdown_3",
        attrs="unit_measure unit_mult unit_type agg_method database_id obs_status obs_conf"),
    "wb_wdi": ViewSpec(
        area="country_code", area_name="country_name", area_rule="iso3", year=("plain", "wb_year"),
        unit="unit_of_measure",
        bags=_bags("country_code country_name", "wb_year_code wb_year periodicity base_period",
                   "indicator_code indicator_name topic long_definition", "",
                   "unit_of_measure other_notes aggregation_method limitations_and_exceptions source "
                   "statistical_concept_and_methodology development_relevance note_country_series "
                   "note_series_time note_footnote")),
    "wb_wgi": _world_bank(
        dims="sex age urbanisation comp_breakdown_1 comp_breakdown_2 comp_breakdown_3",
        attrs="unit_measure unit_mult unit_type decimals database_id obs_status obs_conf"),
}
