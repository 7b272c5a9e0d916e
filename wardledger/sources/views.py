"""View definitions: which flat columns a FHIR resource yields.

Each view pairs columns with paths; ``nested`` are the columns of an element of
``for_each``. The public JSON form of a view definition can be loaded as well.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class View:
    resource: str
    columns: tuple[tuple[str, str], ...]
    for_each: str | None = None
    nested: tuple[tuple[str, str], ...] = field(default=())

    @classmethod
    def from_json(cls, text: str) -> "View":
        definition = json.loads(text)
        columns: list[tuple[str, str]] = []
        nested: list[tuple[str, str]] = []
        for_each = None
        for block in definition["select"]:
            pairs = [(c["name"], c["path"]) for c in block.get("column", [])]
            if "forEach" in block:
                if for_each is not None:
                    raise ValueError("a view may hold one forEach")
                for_each = block["forEach"]
                nested.extend(pairs)
            else:
                columns.extend(pairs)
        return cls(definition["resource"], tuple(columns), for_each, tuple(nested))

    @classmethod
    def load(cls, path: str) -> "View":
        return cls.from_json(Path(path).read_text(encoding="utf-8"))

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in (*self.columns, *self.nested)]


# ---- fixed values: flat columns and their paths -----------------------------
VIEWS: dict[str, View] = {
    "allergy_intolerance": View(
        "AllergyIntolerance",
        (
            ("id", "id"),
            ("identifier_value", "identifier.where(use='official').value.first()"),
            ("clinical_status", "clinicalStatus.coding.first().code"),
            ("verification_status", "verificationStatus.coding.first().code"),
            ("category", "category.first()"),
            ("code", "code.coding.first().code"),
            ("code_display", "code.coding.first().display"),
            ("code_text", "code.text"),
            ("patient_ref", "patient.reference"),
            ("encounter_ref", "encounter.reference"),
            ("recorder_ref", "recorder.reference"),
        ),
    ),
    "careplan": View(
        "CarePlan",
        (
            ("id", "id"),
            ("status", "status"),
            ("intent", "intent"),
            ("title", "title"),
            ("description", "description"),
            ("category_code", "category.first().coding.first().code"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("author_ref", "author.reference"),
        ),
    ),
    "composition": View(
        "Composition",
        (
            ("id", "id"),
            ("status", "status"),
            ("type_code", "type.coding.first().code"),
            ("type_display", "type.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("date", "date"),
            ("author_ref", "author.first().reference"),
            ("title", "title"),
        ),
    ),
    "composition_section": View(
        "Composition",
        (
            ("composition_id", "id"),
        ),
        for_each="section",
        nested=(
            ("section_title", "title"),
            ("section_code", "code.coding.first().code"),
        ),
    ),
    "condition": View(
        "Condition",
        (
            ("id", "id"),
            ("clinical_status", "clinicalStatus.coding.first().code"),
            ("category_code", "category.first().coding.first().code"),
            ("code", "code.coding.first().code"),
            ("code_display", "code.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("subject_display", "subject.display"),
            ("encounter_ref", "encounter.reference"),
        ),
    ),
    "diagnostic_report": View(
        "DiagnosticReport",
        (
            ("id", "id"),
            ("status", "status"),
            ("category_code", "category.first().coding.first().code"),
            ("code", "code.coding.first().code"),
            ("code_display", "code.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("effective_datetime", "effectiveDateTime"),
            ("issued", "issued"),
            ("performer_ref", "performer.first().reference"),
            ("based_on_ref", "basedOn.first().reference"),
            ("conclusion_code", "conclusionCode.first().coding.first().code"),
        ),
    ),
    "diagnostic_report_result": View(
        "DiagnosticReport",
        (
            ("report_id", "id"),
        ),
        for_each="result",
        nested=(
            ("result_observation_ref", "reference"),
        ),
    ),
    "encounter": View(
        "Encounter",
        (
            ("id", "id"),
            ("identifier_value", "identifier.first().value"),
            ("status", "status"),
            ("class_code", "class.code"),
            ("class_display", "class.display"),
            ("subject_ref", "subject.reference"),
            ("subject_display", "subject.display"),
            ("period_start", "period.start"),
            ("period_end", "period.end"),
            ("location_ref", "location.first().location.reference"),
            ("service_provider_ref", "serviceProvider.reference"),
        ),
    ),
    "encounter_participant": View(
        "Encounter",
        (
            ("encounter_id", "id"),
        ),
        for_each="participant",
        nested=(
            ("participant_type_code", "type.first().coding.first().code"),
            ("participant_type_display", "type.first().coding.first().display"),
            ("individual_ref", "individual.reference"),
            ("individual_display", "individual.display"),
        ),
    ),
    "episode_of_care": View(
        "EpisodeOfCare",
        (
            ("id", "id"),
            ("status", "status"),
            ("identifier_value", "identifier.first().value"),
            ("type_code", "type.first().coding.first().code"),
            ("patient_ref", "patient.reference"),
            ("managing_organization_ref", "managingOrganization.reference"),
            ("period_start", "period.start"),
        ),
    ),
    "imaging_study": View(
        "ImagingStudy",
        (
            ("id", "id"),
            ("identifier_value", "identifier.first().value"),
            ("status", "status"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("started", "started"),
            ("based_on_ref", "basedOn.first().reference"),
            ("modality_code", "modality.first().code"),
            ("number_of_series", "numberOfSeries"),
            ("number_of_instances", "numberOfInstances"),
        ),
    ),
    "immunization": View(
        "Immunization",
        (
            ("id", "id"),
            ("status", "status"),
            ("vaccine_code", "vaccineCode.coding.first().code"),
            ("vaccine_display", "vaccineCode.coding.first().display"),
            ("patient_ref", "patient.reference"),
            ("encounter_ref", "encounter.reference"),
            ("occurrence_datetime", "occurrenceDateTime"),
            ("primary_source", "primarySource"),
            ("lot_number", "lotNumber"),
            ("expiration_date", "expirationDate"),
            ("performer_ref", "performer.first().actor.reference"),
            ("reason_code", "reasonCode.first().coding.first().code"),
        ),
    ),
    "medication_dispense": View(
        "MedicationDispense",
        (
            ("id", "id"),
            ("identifier_value", "identifier.where(use='official').value.first()"),
            ("status", "status"),
            ("medication_ref", "medicationReference.reference"),
            ("subject_ref", "subject.reference"),
            ("context_ref", "context.reference"),
            ("when_handed_over", "whenHandedOver"),
            ("authorizing_prescription_ref", "authorizingPrescription.first().reference"),
            ("dosage_text", "dosageInstruction.first().text"),
        ),
    ),
    "medication_statement": View(
        "MedicationStatement",
        (
            ("id", "id"),
            ("status", "status"),
            ("category_code", "category.coding.first().code"),
            ("medication_code", "medicationCodeableConcept.coding.first().code"),
            ("medication_display", "medicationCodeableConcept.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("context_ref", "context.reference"),
            ("date_asserted", "dateAsserted"),
            ("information_source_ref", "informationSource.reference"),
            ("note_text", "note.first().text"),
        ),
    ),
    "observation": View(
        "Observation",
        (
            ("id", "id"),
            ("status", "status"),
            ("category_code", "category.first().coding.first().code"),
            ("code", "code.coding.first().code"),
            ("code_display", "code.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("performer_ref", "performer.first().reference"),
            ("effective_datetime", "effectiveDateTime"),
            ("value", "valueQuantity.value"),
            ("unit", "valueQuantity.unit"),
        ),
    ),
    "procedure": View(
        "Procedure",
        (
            ("id", "id"),
            ("status", "status"),
            ("category_code", "category.coding.first().code"),
            ("code", "code.coding.first().code"),
            ("code_display", "code.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("performer_ref", "performer.first().actor.reference"),
        ),
    ),
    "questionnaire_response": View(
        "QuestionnaireResponse",
        (
            ("id", "id"),
            ("status", "status"),
            ("questionnaire", "questionnaire"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("authored", "authored"),
            ("author_ref", "author.reference"),
            ("source_ref", "source.reference"),
        ),
    ),
    "questionnaire_response_item": View(
        "QuestionnaireResponse",
        (
            ("questionnaire_response_id", "id"),
        ),
        for_each="item",
        nested=(
            ("link_id", "linkId"),
            ("question_text", "text"),
            ("answer_string", "answer.first().valueString"),
            ("answer_boolean", "answer.first().valueBoolean"),
        ),
    ),
    "service_request": View(
        "ServiceRequest",
        (
            ("id", "id"),
            ("identifier_value", "identifier.first().value"),
            ("status", "status"),
            ("intent", "intent"),
            ("category_code", "category.first().coding.first().code"),
            ("code", "code.coding.first().code"),
            ("code_display", "code.coding.first().display"),
            ("subject_ref", "subject.reference"),
            ("encounter_ref", "encounter.reference"),
            ("authored_on", "authoredOn"),
            ("requester_ref", "requester.reference"),
            ("performer_ref", "performer.first().reference"),
        ),
    ),
    "specimen": View(
        "Specimen",
        (
            ("id", "id"),
            ("identifier_value", "identifier.where(use='official').value.first()"),
            ("status", "status"),
            ("type_code", "type.coding.first().code"),
            ("subject_ref", "subject.reference"),
            ("request_ref", "request.first().reference"),
            ("collected_datetime", "collection.collectedDateTime"),
            ("collector_ref", "collection.collector.reference"),
        ),
    ),
}
# ---- end of fixed values ----------------------------------------------------
