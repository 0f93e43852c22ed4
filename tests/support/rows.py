"""Rows shared by tests."""

#: ``name_place`` records.
PEOPLE = ["Ada_LND", "Bo_OSL", "Cy_ROM", "Dora_VIE", "Eva_BRN", "Finn_DUB", "Gus_RIX", "Hana_TKO", "Ivo_PRG"]
