"""Column contracts of the source (bronze) tables.

A table lists its columns with their types in the order of the source. The columns
that every record begins with, and the notes of its users, are stated once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DECIMAL": T.DecimalType(21, 9),
}

Columns = tuple[tuple[str, str], ...]

# ---- fixed values: column names and types of the source system -------------
RECORD_HEAD = (
    ("name", "STRING"), ("creation", "TIMESTAMP"), ("modified", "TIMESTAMP"), ("modified_by", "STRING"),
    ("owner", "STRING"), ("docstatus", "INT"), ("idx", "INT"),
)
RECORD_TAIL = (
    ("_user_tags", "STRING"), ("_comments", "STRING"), ("_assign", "STRING"), ("_liked_by", "STRING"),
)
MASTER_TABLES: dict[str, Columns] = {
    "tabPatient": (
        *RECORD_HEAD, ("naming_series", "STRING"), ("first_name", "STRING"), ("middle_name", "STRING"),
        ("last_name", "STRING"), ("patient_name", "STRING"), ("sex", "STRING"), ("blood_group", "STRING"),
        ("dob", "DATE"), ("image", "STRING"), ("status", "STRING"), ("uid", "STRING"), ("inpatient_record", "STRING"),
        ("inpatient_status", "STRING"), ("report_preference", "STRING"), ("mobile", "STRING"), ("phone", "STRING"),
        ("email", "STRING"), ("invite_user", "INT"), ("user_id", "STRING"), ("customer", "STRING"),
        ("customer_group", "STRING"), ("territory", "STRING"), ("default_currency", "STRING"),
        ("default_price_list", "STRING"), ("language", "STRING"), ("patient_details", "STRING"),
        ("occupation", "STRING"), ("marital_status", "STRING"), ("allergies", "STRING"), ("medication", "STRING"),
        ("medical_history", "STRING"), ("surgical_history", "STRING"), ("tobacco_past_use", "STRING"),
        ("tobacco_current_use", "STRING"), ("alcohol_past_use", "STRING"), ("alcohol_current_use", "STRING"),
        ("surrounding_factors", "STRING"), ("other_risk_factors", "STRING"), *RECORD_TAIL,
        ("satusehat_resource_type", "STRING"), ("satusehat_id", "STRING"), ("fhir_status", "STRING"),
        ("satusehat_resource_id", "STRING"),
    ),
    "tabPatientEncounter": (
        *RECORD_HEAD, ("naming_series", "STRING"), ("title", "STRING"), ("appointment", "STRING"),
        ("appointment_type", "STRING"), ("patient", "STRING"), ("patient_name", "STRING"), ("patient_sex", "STRING"),
        ("patient_age", "STRING"), ("inpatient_record", "STRING"), ("inpatient_status", "STRING"),
        ("company", "STRING"), ("status", "STRING"), ("encounter_date", "DATE"), ("encounter_time", "STRING"),
        ("practitioner", "STRING"), ("practitioner_name", "STRING"), ("medical_department", "STRING"),
        ("google_meet_link", "STRING"), ("invoiced", "INT"), ("submit_orders_on_save", "INT"),
        ("symptoms_in_print", "INT"), ("diagnosis_in_print", "INT"), ("therapy_plan", "STRING"),
        ("encounter_comment", "STRING"), ("amended_from", "STRING"), *RECORD_TAIL, ("_seen", "STRING"),
        ("satusehat_resource_type", "STRING"), ("fhir_status", "STRING"), ("satusehat_resource_id", "STRING"),
    ),
    "tabHealthcarePractitioner": (
        *RECORD_HEAD, ("naming_series", "STRING"), ("first_name", "STRING"), ("middle_name", "STRING"),
        ("last_name", "STRING"), ("practitioner_name", "STRING"), ("gender", "STRING"), ("image", "STRING"),
        ("status", "STRING"), ("mobile_phone", "STRING"), ("residence_phone", "STRING"), ("office_phone", "STRING"),
        ("practitioner_type", "STRING"), ("employee", "STRING"), ("supplier", "STRING"), ("department", "STRING"),
        ("designation", "STRING"), ("user_id", "STRING"), ("hospital", "STRING"), ("google_calendar", "STRING"),
        ("op_consulting_charge_item", "STRING"), ("op_consulting_charge", "DECIMAL"),
        ("inpatient_visit_charge_item", "STRING"), ("inpatient_visit_charge", "DECIMAL"),
        ("default_currency", "STRING"), ("practitioner_primary_contact", "STRING"), ("mobile_no", "STRING"),
        ("email_id", "STRING"), ("practitioner_primary_address", "STRING"), ("primary_address", "STRING"),
        *RECORD_TAIL, ("satusehat_resource_type", "STRING"), ("nik", "STRING"), ("satusehat_id", "STRING"),
        ("fhir_status", "STRING"), ("satusehat_resource_id", "STRING"),
    ),
    "tabItem": (
        *RECORD_HEAD, ("naming_series", "STRING"), ("item_code", "STRING"), ("item_name", "STRING"),
        ("item_group", "STRING"), ("stock_uom", "STRING"), ("disabled", "INT"), ("allow_alternative_item", "INT"),
        ("is_stock_item", "INT"), ("has_variants", "INT"), ("opening_stock", "DECIMAL"),
        ("valuation_rate", "DECIMAL"), ("standard_rate", "DECIMAL"), ("is_fixed_asset", "INT"),
        ("auto_create_assets", "INT"), ("is_grouped_asset", "INT"), ("asset_category", "STRING"),
        ("asset_naming_series", "STRING"), ("over_delivery_receipt_allowance", "DECIMAL"),
        ("over_billing_allowance", "DECIMAL"), ("image", "STRING"), ("description", "STRING"), ("brand", "STRING"),
        ("shelf_life_in_days", "INT"), ("end_of_life", "DATE"), ("default_material_request_type", "STRING"),
        ("valuation_method", "STRING"), ("warranty_period", "STRING"), ("weight_per_unit", "DECIMAL"),
        ("weight_uom", "STRING"), ("allow_negative_stock", "INT"), ("has_batch_no", "INT"),
        ("create_new_batch", "INT"), ("batch_number_series", "STRING"), ("has_expiry_date", "INT"),
        ("retain_sample", "INT"), ("sample_quantity", "INT"), ("has_serial_no", "INT"),
        ("serial_no_series", "STRING"), ("variant_of", "STRING"), ("variant_based_on", "STRING"),
        ("enable_deferred_expense", "INT"), ("no_of_months_exp", "INT"), ("enable_deferred_revenue", "INT"),
        ("no_of_months", "INT"), ("purchase_uom", "STRING"), ("min_order_qty", "DECIMAL"),
        ("safety_stock", "DECIMAL"), ("is_purchase_item", "INT"), ("lead_time_days", "INT"),
        ("last_purchase_rate", "DECIMAL"), ("is_customer_provided_item", "INT"), ("customer", "STRING"),
        ("delivered_by_supplier", "INT"), ("country_of_origin", "STRING"), ("customs_tariff_number", "STRING"),
        ("sales_uom", "STRING"), ("grant_commission", "INT"), ("is_sales_item", "INT"), ("max_discount", "DECIMAL"),
        ("inspection_required_before_purchase", "INT"), ("quality_inspection_template", "STRING"),
        ("inspection_required_before_delivery", "INT"), ("include_item_in_manufacturing", "INT"),
        ("is_sub_contracted_item", "INT"), ("default_bom", "STRING"), ("customer_code", "STRING"),
        ("default_item_manufacturer", "STRING"), ("default_manufacturer_part_no", "STRING"),
        ("total_projected_qty", "DECIMAL"), *RECORD_TAIL, ("kfa_code", "STRING"), ("kfa_display", "STRING"),
        ("satusehat_id", "STRING"),
    ),
}

EXCHANGE_TABLES: dict[str, Columns] = {
    "tabAllergyIntolerance_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"), ("clinical_status", "STRING"),
        ("verification_status", "STRING"), ("category", "STRING"), ("snomed_code", "STRING"),
        ("snomed_display", "STRING"), ("allergy_text", "STRING"), ("status", "STRING"), ("satusehat_id", "STRING"),
        ("api_response", "STRING"), *RECORD_TAIL, ("payload_json", "STRING"),
    ),
    "tabCarePlan_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"), ("title", "STRING"),
        ("description", "STRING"), ("status", "STRING"), ("satusehat_id", "STRING"), ("api_response", "STRING"),
        ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabComposition_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("composition_title", "STRING"), ("patient_ihs", "STRING"),
        ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"), ("status", "STRING"),
        ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabCondition_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_encounter", "STRING"), ("patient", "STRING"),
        ("patient_name", "STRING"), ("patient_ihs", "STRING"), ("satusehat_encounter_id", "STRING"),
        ("icd_code", "STRING"), ("diagnosis_display", "STRING"), ("validation_status", "STRING"),
        ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabDiagnosticReport_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("servicerequest_satusehat", "STRING"),
        ("specimen_satusehat", "STRING"), ("observation_satusehat", "STRING"), ("patient_name", "STRING"),
        ("patient_ihs", "STRING"), ("practitioner_ihs", "STRING"), ("report_code", "STRING"),
        ("report_display", "STRING"), ("conclusion_code", "STRING"), ("conclusion_display", "STRING"),
        ("status", "STRING"), ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"),
        *RECORD_TAIL,
    ),
    "tabEncounter_SatuSehat": (
        *RECORD_HEAD, ("patient_encounter", "STRING"), ("patient", "STRING"), ("patient_name", "STRING"),
        ("patient_ihs", "STRING"), ("practitioner", "STRING"), ("practitioner_name", "STRING"),
        ("practitioner_ihs", "STRING"), ("start_time", "TIMESTAMP"), ("organization_id", "STRING"),
        ("location_id", "STRING"), ("satusehat_id", "STRING"), ("status", "STRING"), ("api_response", "STRING"),
        ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabEpisodeOfCare_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("identifier_value", "STRING"), ("type_code", "STRING"), ("type_display", "STRING"), ("start_date", "DATE"),
        ("status", "STRING"), ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"),
        *RECORD_TAIL,
    ),
    "tabImagingStudy_SatuSehat": (
        *RECORD_HEAD, ("servicerequest_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("satusehat_encounter_id", "STRING"), ("satusehat_servicerequest_id", "STRING"), ("modality_code", "STRING"),
        ("modality_display", "STRING"), ("dicom_uid", "STRING"), ("status", "STRING"), ("satusehat_id", "STRING"),
        ("api_response", "STRING"), *RECORD_TAIL, ("payload_json", "STRING"),
    ),
    "tabImmunization_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"), ("vaccine_code", "STRING"),
        ("vaccine_display", "STRING"), ("occurrence_datetime", "TIMESTAMP"), ("lot_number", "STRING"),
        ("expiration_date", "DATE"), ("dose_number", "INT"), ("status", "STRING"), ("satusehat_id", "STRING"),
        ("api_response", "STRING"), ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabMedicationDispense_SatuSehat": (
        *RECORD_HEAD, ("medication_request_satusehat", "STRING"), ("patient_name", "STRING"),
        ("patient_ihs", "STRING"), ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"),
        ("status", "STRING"), ("payload_json", "STRING"), ("api_response", "STRING"), *RECORD_TAIL,
    ),
    "tabMedicationStatement_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("satusehat_encounter_id", "STRING"), ("item_code", "STRING"), ("medication_code", "STRING"),
        ("medication_display", "STRING"), ("date_asserted", "TIMESTAMP"), ("note", "STRING"), ("status", "STRING"),
        ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabObservation_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("vital_signs", "STRING"), ("patient", "STRING"),
        ("patient_name", "STRING"), ("patient_ihs", "STRING"), ("practitioner_ihs", "STRING"),
        ("satusehat_encounter_id", "STRING"), ("validation_status", "STRING"), ("satusehat_ids", "STRING"),
        ("api_response", "STRING"), ("payload_json", "STRING"), *RECORD_TAIL,
    ),
    "tabProcedure_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("clinical_procedure", "STRING"), ("patient", "STRING"),
        ("patient_name", "STRING"), ("patient_ihs", "STRING"), ("practitioner_ihs", "STRING"),
        ("satusehat_encounter_id", "STRING"), ("procedure_code", "STRING"), ("procedure_display", "STRING"),
        ("status", "STRING"), ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"),
        *RECORD_TAIL,
    ),
    "tabQuestionnaireResponse_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"), ("questionnaire_url", "STRING"),
        ("authored_datetime", "TIMESTAMP"), ("keluhan_utama", "STRING"), ("riwayat_alergi", "INT"),
        ("status", "STRING"), ("satusehat_id", "STRING"), ("api_response", "STRING"), ("payload_json", "STRING"),
        *RECORD_TAIL,
    ),
    "tabServiceRequest_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("patient_name", "STRING"), ("patient_ihs", "STRING"),
        ("practitioner_ihs", "STRING"), ("satusehat_encounter_id", "STRING"), ("loinc_code", "STRING"),
        ("loinc_display", "STRING"), ("request_text", "STRING"), ("status", "STRING"), ("satusehat_id", "STRING"),
        ("api_response", "STRING"), *RECORD_TAIL, ("payload_json", "STRING"),
    ),
    "tabSpecimen_SatuSehat": (
        *RECORD_HEAD, ("encounter_satusehat", "STRING"), ("servicerequest_satusehat", "STRING"),
        ("patient_name", "STRING"), ("patient_ihs", "STRING"), ("practitioner_ihs", "STRING"),
        ("specimen_identifier", "STRING"), ("specimen_code", "STRING"), ("specimen_display", "STRING"),
        ("collected_datetime", "TIMESTAMP"), ("status", "STRING"), ("satusehat_id", "STRING"),
        ("api_response", "STRING"), ("payload_json", "STRING"), *RECORD_TAIL,
    ),
}

# Reference code lists: every column is text.
CODE_LISTS: dict[str, Columns] = {
    "icd_10": (("CODE", "STRING"), ("DISPLAY", "STRING"), ("VERSION", "STRING")),
    "icd_9cm": (("CODE", "STRING"), ("DISPLAY", "STRING"), ("VERSION", "STRING")),
    "icd_pm": (("CODE", "STRING"), ("DISPLAY", "STRING"), ("VERSION", "STRING")),
    "icd_o": (("CODE", "STRING"), ("STR", "STRING"), ("SAB", "STRING")),
    "icd_mm": (("LEVEL", "STRING"), ("CODE", "STRING"), ("DISPLAY", "STRING"), ("VERSION", "STRING")),
}
CODE_LIST_KEYS = {"icd_o": ("CODE", "SAB"), "icd_mm": ("CODE", "VERSION")}
# ---- end of fixed values ---------------------------------------------------


@dataclass(frozen=True)
class Field:
    name: str
    type: str

    @property
    def spark_type(self) -> T.DataType:
        return TYPES[self.type]


def struct_of(fields: tuple[Field, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.spark_type) for f in fields])


def bronze_fields(table: str) -> tuple[Field, ...]:
    """All columns of one source table."""
    return tuple(Field(*column) for column in (MASTER_TABLES | EXCHANGE_TABLES)[table])


def bronze_schema(table: str) -> T.StructType:
    return struct_of(bronze_fields(table))


def code_list_schema(name: str) -> T.StructType:
    return struct_of(tuple(Field(*column) for column in CODE_LISTS[name]))


def code_list_key(name: str) -> tuple[str, ...]:
    return CODE_LIST_KEYS.get(name, ("CODE", "VERSION"))


def bronze_tables() -> list[str]:
    return [*MASTER_TABLES, *EXCHANGE_TABLES]
