"""Country names as feeds spell them, against names as the area reference has them."""

from __future__ import annotations

import pytest

from indicatorlake.operators.areas import alias_table, name_codes, region_table

# M49 codes and names of the areas met below and of those they may be taken for.
REFERENCE = {
    "004": "Afghanistan", "010": "Antarctica", "012": "Algeria", "024": "Angola", "031": "Azerbaijan", "044": "Bahamas", "050": "Bangladesh",
    "056": "Belgium", "068": "Bolivia (Plurinational State of)", "070": "Bosnia and Herzegovina", "084": "Belize", "092": "British Virgin Islands",
    "096": "Brunei Darussalam", "104": "Myanmar", "116": "Cambodia", "120": "Cameroon", "132": "Cabo Verde", "140": "Central African Republic", "148": "Chad",
    "156": "China", "158": "China, Taiwan Province of China", "174": "Comoros", "178": "Congo", "180": "Democratic Republic of the Congo", "184": "Cook Islands",
    "203": "Czechia", "208": "Denmark", "212": "Dominica", "214": "Dominican Republic", "226": "Equatorial Guinea", "238": "Falkland Islands (Malvinas)",
    "250": "France", "254": "French Guiana", "258": "French Polynesia", "270": "Gambia", "275": "State of Palestine", "276": "Germany", "288": "Ghana",
    "300": "Greece", "324": "Guinea", "328": "Guyana", "336": "Holy See", "340": "Honduras", "344": "China, Hong Kong Special Administrative Region",
    "356": "India", "360": "Indonesia", "364": "Iran (Islamic Republic of)", "372": "Ireland", "384": "Côte d’Ivoire", "408": "Democratic People's Republic of Korea",
    "410": "Republic of Korea", "417": "Kyrgyzstan", "418": "Lao People's Democratic Republic", "434": "Libya", "442": "Luxembourg",
    "446": "China, Macao Special Administrative Region", "466": "Mali", "498": "Republic of Moldova", "528": "Netherlands (Kingdom of the)", "530": "Netherlands Antilles",
    "535": "Bonaire, Sint Eustatius and Saba", "554": "New Zealand", "562": "Niger", "566": "Nigeria", "580": "Northern Mariana Islands",
    "581": "United States Minor Outlying Islands", "583": "Micronesia (Federated States of)", "584": "Marshall Islands", "598": "Papua New Guinea",
    "608": "Philippines", "624": "Guinea-Bissau", "626": "Timor-Leste", "638": "Réunion", "642": "Romania", "643": "Russian Federation", "654": "Saint Helena",
    "659": "Saint Kitts and Nevis", "662": "Saint Lucia", "670": "Saint Vincent and the Grenadines", "678": "Sao Tome and Principe", "682": "Saudi Arabia",
    "688": "Serbia", "703": "Slovakia", "704": "Viet Nam", "710": "South Africa", "728": "South Sudan", "729": "Sudan", "736": "North Sudan", "748": "Eswatini",
    "756": "Switzerland", "760": "Syrian Arab Republic", "776": "Tonga", "780": "Trinidad and Tobago", "784": "United Arab Emirates", "788": "Tunisia",
    "792": "Türkiye", "807": "North Macedonia", "818": "Egypt", "826": "United Kingdom of Great Britain and Northern Ireland",
    "834": "United Republic of Tanzania", "840": "United States of America", "850": "United States Virgin Islands", "862": "Venezuela (Bolivarian Republic of)",
    "887": "Yemen", "894": "Zambia",
}
SPELLINGS = {
    "044": ["Bahamas", "The Bahamas", "Bahamas, The"], "068": ["Bolivia", "Plurinational State of Bolivia", "Bolivia, Plurinational State of"],
    "070": ["Bosnia", "Bosnia & Herzegovina", "Bosnia-Herzegovina"], "092": ["Virgin Islands, British", "British Virgin Islands", "Virgin Is. (British)"],
    "096": ["Brunei"], "104": ["Burma", "Myanmar (Burma)"], "132": ["Cape Verde"], "140": ["Central African Rep.", "Central African Republic, The"],
    "156": ["China, mainland", "China mainland", "People's Republic of China", "China"], "158": ["Taiwan", "Taiwan, China", "China, Taiwan Province of"],
    "178": ["Congo, Rep.", "Republic of the Congo", "Congo-Brazzaville", "Congo Brazzaville"],
    "180": ["DRC", "Congo-Kinshasa", "Congo, Dem. Rep.", "DR Congo", "Democratic Republic of Congo", "Dem. Rep. of the Congo"], "203": ["Czech Republic", "Czech Rep."],
    "212": ["Dominica", "Commonwealth of Dominica"], "214": ["Dominican Rep.", "Dominican Republic"], "226": ["Equatorial Guinea", "Equatorial Guinea, Republic of"],
    "238": ["Falkland Islands", "Falkland Is."], "270": ["Gambia, The", "The Gambia"], "275": ["Palestine", "Palestinian Territories", "West Bank and Gaza"],
    "276": ["Federal Republic of Germany", "Germany"], "324": ["Guinea", "Republic of Guinea", "Guinea, Rep. of"], "336": ["Holy See (Vatican City State)", "Vatican City", "Vatican"],
    "344": ["China, Hong Kong SAR", "Hong Kong", "Hong Kong SAR, China"], "446": ["China, Macao SAR", "Macau", "Macao SAR, China"],
    "364": ["Iran", "Iran, Islamic Rep.", "Islamic Republic of Iran"], "384": ["Cote dIvoire", "Cote d'Ivoire", "Ivory Coast", "Côte d'Ivoire"],
    "408": ["North Korea", "Korea, Dem. People's Rep.", "Korea, DPR"], "410": ["South Korea", "Korea, Rep.", "Korea, Republic of"],
    "417": ["Kyrgyz Republic"], "418": ["Laos", "Lao PDR"], "434": ["Libyan Arab Jamahiriya"], "498": ["Moldova", "Moldova, Rep. of"],
    "528": ["Netherlands", "The Netherlands", "Netherlands, The", "Kingdom of the Netherlands"], "562": ["Niger", "Republic of Niger", "Niger, Rep."],
    "566": ["Nigeria", "Federal Republic of Nigeria"], "583": ["Micronesia", "Micronesia, Fed. Sts.", "Federated States of Micronesia"], "584": ["Marshall Is."],
    "598": ["Papua New Guinea"], "624": ["Guinea Bissau", "Republic of Guinea-Bissau"], "626": ["East Timor", "Timor Leste"], "643": ["Russia"], "659": ["St. Kitts and Nevis"],
    "662": ["St. Lucia"], "670": ["St. Vincent & the Grenadines", "Saint Vincent and Grenadines"], "678": ["Sao Tome & Principe", "São Tomé and Príncipe"],
    "703": ["Slovak Republic"], "704": ["Vietnam"], "728": ["South Sudan", "Republic of South Sudan", "South Sudan, Rep."], "729": ["Sudan", "Sudan, Republic of", "Republic of the Sudan"],
    "748": ["Swaziland"], "760": ["Syria", "Syrian Arab Rep."], "784": ["UAE"], "792": ["Turkey", "Turkiye"], "807": ["Macedonia", "Macedonia, FYR"], "818": ["Egypt, Arab Rep."],
    "826": ["UK", "United Kingdom", "Great Britain"], "834": ["Tanzania", "Tanzania, United Rep. of"], "840": ["US", "U.S.", "USA", "U.S.A.", "United States"],
    "850": ["US Virgin Islands", "Virgin Islands (U.S.)", "Virgin Islands, United States"], "862": ["Venezuela", "Venezuela, RB"], "887": ["Yemen, Rep."],
}
NONE = ["Virgin Islands", "Nowhere", "Guinea and Niger", "Northern Islands", "Republic", "Guiana Guinea", "Republic of the Islands", "New Caledonia", "Saint", "Guinea and Togo",
        "Netherlands, Belgium and Luxembourg", "Northern Ireland", "United", "Islands"]


@pytest.fixture(scope="module")
def found(spark):
    areas = spark.createDataFrame([(c, n) for c, n in REFERENCE.items()], "m49_code string, area_name string")
    names = [*(n for spelled in SPELLINGS.values() for n in spelled), *NONE, *REFERENCE.values()]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return dict(map(tuple, name_codes(df, "name", "code", areas, region_table(spark), alias_table(spark), by_words=True).collect()))


def test_common_spellings_get_their_code(found):
    wrong = {n: (found[n], code) for code, spelled in SPELLINGS.items() for n in spelled if found[n] != code}
    assert wrong == {}
    assert sum(map(len, SPELLINGS.values())) > 106


def test_every_reference_name_gets_its_own_code(found):
    assert {n: found[n] for c, n in REFERENCE.items() if found[n] != c} == {}


def test_names_of_no_area_or_of_several_get_none(found):
    assert {n: found[n] for n in NONE if found[n]} == {}
