"""The sixteen exchanged resources as configuration.

Passthrough columns are output names with their source columns; every resource
starts with those of ``DOCUMENT``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from .views import VIEWS, View


@dataclass(frozen=True)
class Resource:
    name: str
    table: str
    carried: dict[str, str]
    types: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    is_array: bool = False
    index_column: str | None = None

    @property
    def view(self) -> View:
        return VIEWS[self.name]

    @property
    def passthrough(self) -> dict[str, str]:
        """Output name -> source column."""
        return DOCUMENT | self.carried

    @property
    def grain(self) -> tuple[str, ...]:
        return ("frappe_doc_name", self.index_column) if self.is_array else ("frappe_doc_name",)

    @property
    def silver_table(self) -> str:
        return f"{self.name}_fhir_resource"

    @property
    def parent_table(self) -> str:
        return f"{self.name}_satusehat_data_clean"

    @property
    def audit_table(self) -> str:
        return f"{self.name}_satusehat_data_submission_audit"


def same(*names: str) -> dict[str, str]:
    """Columns that keep their names."""
    return {name: name for name in names}


# ---- fixed values: carried columns, types and names of the silver tables ----
DOCUMENT = {"frappe_doc_name": "name", "modified": "modified", "docstatus": "docstatus"}
ID = {"id": "fhir_id"}
ID_AND_STATUS = {"id": "fhir_id", "status": "fhir_status"}

_ALL = (
    Resource(
        "allergy_intolerance", "tabAllergyIntolerance_SatuSehat",
        {
            **same(
                "encounter_satusehat", "patient_name", "patient_ihs", "practitioner_ihs", "satusehat_encounter_id",
            ),
            "frappe_status": "status",
            **same("satusehat_id"),
        },
        renames=ID,
    ),
    Resource(
        "careplan", "tabCarePlan_SatuSehat",
        same(
            "encounter_satusehat", "patient_name", "patient_ihs", "practitioner_ihs", "satusehat_encounter_id",
            "satusehat_id",
        ),
        renames=ID,
    ),
    Resource(
        "composition", "tabComposition_SatuSehat",
        same(
            "encounter_satusehat", "composition_title", "patient_ihs", "practitioner_ihs", "satusehat_encounter_id",
            "satusehat_id",
        ),
        renames=ID,
    ),
    Resource(
        "condition", "tabCondition_SatuSehat",
        same(
            "encounter_satusehat", "patient", "patient_name", "patient_ihs", "satusehat_encounter_id", "icd_code",
            "diagnosis_display", "validation_status", "satusehat_id",
        ),
        renames=ID,
    ),
    Resource(
        "diagnostic_report", "tabDiagnosticReport_SatuSehat",
        same(
            "encounter_satusehat", "servicerequest_satusehat", "specimen_satusehat", "observation_satusehat",
            "patient_name", "patient_ihs", "practitioner_ihs", "satusehat_id",
        ),
        types={"issued": "TIMESTAMP"},
        renames=ID,
    ),
    Resource(
        "encounter", "tabEncounter_SatuSehat",
        {
            **same(
                "patient", "patient_name", "patient_ihs", "practitioner", "practitioner_name", "practitioner_ihs",
                "start_time", "organization_id", "location_id", "satusehat_id",
            ),
            "frappe_status": "status",
        },
        types={"period_start": "TIMESTAMP", "period_end": "TIMESTAMP"},
        renames=ID_AND_STATUS,
    ),
    Resource(
        "episode_of_care", "tabEpisodeOfCare_SatuSehat",
        same(
            "encounter_satusehat", "patient_name", "patient_ihs", "satusehat_id",
        ),
        types={"period_start": "TIMESTAMP"},
        renames=ID,
    ),
    Resource(
        "imaging_study", "tabImagingStudy_SatuSehat",
        same(
            "servicerequest_satusehat", "patient_name", "patient_ihs", "satusehat_encounter_id",
            "satusehat_servicerequest_id", "satusehat_id",
        ),
        types={"started": "TIMESTAMP", "number_of_instances": "INT"},
        renames=ID,
    ),
    Resource(
        "immunization", "tabImmunization_SatuSehat",
        same(
            "encounter_satusehat", "patient_name", "patient_ihs", "practitioner_ihs", "satusehat_encounter_id",
            "satusehat_id",
        ),
        types={"occurrence_datetime": "TIMESTAMP", "primary_source": "BOOLEAN", "expiration_date": "DATE"},
        renames=ID,
    ),
    Resource(
        "medication_dispense", "tabMedicationDispense_SatuSehat",
        {
            **same(
                "medication_request_satusehat", "patient_name", "patient_ihs", "practitioner_ihs",
                "satusehat_encounter_id",
            ),
            "frappe_status": "status",
        },
        types={"when_handed_over": "TIMESTAMP"},
        renames=ID_AND_STATUS,
    ),
    Resource(
        "medication_statement", "tabMedicationStatement_SatuSehat",
        same(
            "encounter_satusehat", "patient_name", "patient_ihs", "satusehat_encounter_id", "item_code",
            "satusehat_id",
        ),
        types={"date_asserted": "TIMESTAMP"},
        renames=ID,
    ),
    Resource(
        "observation", "tabObservation_SatuSehat",
        same(
            "encounter_satusehat", "vital_signs", "patient", "patient_name", "patient_ihs", "practitioner_ihs",
            "satusehat_encounter_id", "validation_status", "satusehat_ids",
        ),
        types={"effective_datetime": "TIMESTAMP", "value": "DOUBLE"},
        renames=ID,
        is_array=True,
        index_column="observation_idx",
    ),
    Resource(
        "procedure", "tabProcedure_SatuSehat",
        same(
            "encounter_satusehat", "clinical_procedure", "patient_name", "patient_ihs", "practitioner_ihs",
            "satusehat_encounter_id", "satusehat_id",
        ),
        renames=ID,
    ),
    Resource(
        "questionnaire_response", "tabQuestionnaireResponse_SatuSehat",
        same(
            "encounter_satusehat", "patient_name", "patient_ihs", "practitioner_ihs", "satusehat_encounter_id",
            "keluhan_utama", "riwayat_alergi", "satusehat_id",
        ),
        types={"authored": "TIMESTAMP"},
        renames=ID,
    ),
    Resource(
        "service_request", "tabServiceRequest_SatuSehat",
        same(
            "encounter_satusehat", "patient_name", "patient_ihs", "practitioner_ihs", "satusehat_encounter_id",
            "satusehat_id",
        ),
        types={"authored_on": "TIMESTAMP"},
        renames=ID,
    ),
    Resource(
        "specimen", "tabSpecimen_SatuSehat",
        same(
            "encounter_satusehat", "servicerequest_satusehat", "patient_name", "patient_ihs", "practitioner_ihs",
            "satusehat_id",
        ),
        types={"collected_datetime": "TIMESTAMP"},
        renames=ID,
    ),
)

# View of a nested element -> the resource it belongs to.
CHILD_VIEWS = {
    "encounter_participant": "encounter",
    "composition_section": "composition",
    "diagnostic_report_result": "diagnostic_report",
    "questionnaire_response_item": "questionnaire_response",
}
# ---- end of fixed values ----------------------------------------------------

RESOURCES: dict[str, Resource] = {r.name: r for r in _ALL}
