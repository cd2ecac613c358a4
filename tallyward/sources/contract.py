"""What the cleaning step expects of the raw table: the columns it reads, and their types."""

from __future__ import annotations

# Source columns by Spark type. The source has hundreds more, which nothing reads.
_COLUMNS = {
    "date": ("date",),
    "string": ("country_code", "country_name", "subregion1_name"),
    "double": ("hospital_beds_per_1000", "stringency_index", "human_development_index"),
    "bigint": (
        "new_confirmed",
        "new_deceased",
        "new_recovered",
        "cumulative_confirmed",
        "cumulative_deceased",
        "new_hospitalized_patients",
        "current_hospitalized_patients",
        "new_intensive_care_patients",
        "current_intensive_care_patients",
        "current_ventilator_patients",
        "new_persons_vaccinated",
        "cumulative_persons_vaccinated",
        "new_persons_fully_vaccinated",
        "cumulative_persons_fully_vaccinated",
        "new_vaccine_doses_administered",
        "cumulative_vaccine_doses_administered",
        "new_vaccine_doses_administered_pfizer",
        "new_vaccine_doses_administered_moderna",
        "new_vaccine_doses_administered_janssen",
        "school_closing",
        "workplace_closing",
        "cancel_public_events",
        "restrictions_on_gatherings",
        "stay_at_home_requirements",
        "international_travel_controls",
        "population",
        "gdp_per_capita_usd",
    ),
}

RAW_CONTRACT = {name: data_type for data_type, names in _COLUMNS.items() for name in names}
