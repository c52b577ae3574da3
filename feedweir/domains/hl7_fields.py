"""Fixed values of HL7 v2: composites and the fields of the segments with a built-in table.

A composite line is ``name component[.subcomponent] [or component] [date]``. A segment line is
``field[.component] type name``; a type with ``*`` repeats. Tables of site-defined segments are a
parameter of ``hl7.segment_table`` in the same notation.
"""

# Composite types and their parts.
COMPOSITES = {
    "xpn": """
family_name 1
given_name 2
middle_name 3
suffix 4
prefix 5
degree 6
name_type_code 7
name_representation_code 8
name_context 9
name_assembly_order 11
name_effective_date 12
name_expiration_date 13
professional_suffix 14
called_by 15
""",
    "xcn": """
id 1
family_name 2
given_name 3
middle_name 4
suffix 5
prefix 6
degree 7
source_table 8
assigning_authority 9.1
assigning_authority_universal_id 9.2
assigning_authority_universal_id_type 9.3
name_type_code 10
check_digit 11
check_digit_scheme 12
identifier_type_code 13
assigning_facility 14.1
assigning_facility_universal_id 14.2
assigning_facility_universal_id_type 14.3
name_representation_code 15
name_assembly_order 18
effective_date 19
expiration_date 20
professional_suffix 21
""",
    "cwe": """
code 1
text 2
coding_system 3
alt_code 4
alt_text 5
alt_coding_system 6
coding_system_version 7
alt_coding_system_version 8
original_text 9
""",
    "hd": """
namespace_id 1
universal_id 2
universal_id_type 3
""",
    "ei": """
entity_identifier 1
namespace_id 2
universal_id 3
universal_id_type 4
""",
    "cp": """
price 1.1 or 1
currency 1.2
price_type 2
from_value 3
to_value 4
range_units 5.1 or 5
range_units_text 5.2
range_units_coding_system 5.3
range_type 6
""",
    "pt": """
id 1
mode 2
""",
    "vid": """
id 1
internationalization 2.1 or 2
internationalization_text 2.2
internationalization_coding_system 2.3
international_version 3.1 or 3
international_version_text 3.2
international_version_coding_system 3.3
""",
    "aui": """
number 1
date 2 date
source 3
""",
    "sps": """
code 1.1 or 1
text 1.2
additives 2.1 or 2
collection_method 3
body_site 4.1 or 4
site_modifier 5.1 or 5
collection_method_modifier 6.1 or 6
role 7.1 or 7
""",
    "dln": """
number 1
issuing_state 2
expiration_date 3 date
""",
    "dld": """
code 1.1 or 1
effective_date 2 date
""",
    "fc": """
code 1.1 or 1
text 1.2
coding_system 1.3
alt_code 1.4
alt_text 1.5
alt_coding_system 1.6
coding_system_version 1.7
alt_coding_system_version 1.8
original_text 1.9
effective_date 2 date
""",
    "tq": """
quantity 1.1 or 1
quantity_units 1.2
interval_repeat_pattern 2.1
interval_explicit_time 2.2
duration 3
start_datetime 4 date
end_datetime 5 date
priority 6
condition 7
text 8
conjunction 9
order_sequencing 10
occurrence_duration 11.1 or 11
total_occurrences 12
""",
    "jcc": """
code 1.1 or 1
text 1.2
coding_system 1.3
class 2.1 or 2
class_text 2.2
class_coding_system 2.3
description 3
""",
    "moc": """
monetary_amount 1.1 or 1
monetary_amount_currency 1.2
charge_code 2.1 or 2
charge_code_text 2.2
charge_code_coding_system 2.3
""",
    "prl": """
code 1.1 or 1
text 1.2
coding_system 1.3
sub_id 2
descriptor 3
""",
    "ndl": """
id 1.1
family_name 1.2
given_name 1.3
middle_name 1.4
suffix 1.5
prefix 1.6
degree 1.7
start_datetime 2 date
end_datetime 3 date
point_of_care 4
room 5
bed 6
facility 7.1 or 7
location_status 8
patient_location_type 9
building 10
floor 11
""",
    "pl": """
point_of_care 1.1 or 1
room 2.1 or 2
bed 3.1 or 3
facility 4.1 or 4
status 5
type 6
building 7.1 or 7
floor 8.1 or 8
description 9
comprehensive_id 10.1 or 10
assigning_authority 11.1 or 11
""",
    "cq": """
quantity 1
units 2.1 or 2
""",
    "xtn": """
number 1
use_code 2
equipment_type 3
communication_address 4
country_code 5
area_code 6
local_number 7
extension 8
any_text 9
extension_prefix 10
speed_dial_code 11
unformatted_number 12
effective_start_date 13
expiration_date 14
expiration_reason 15.1
protection_code 16.1
shared_telecom_id 17.1
preference_order 18
""",
    "xon": """
name 1
type_code 2
id 3
check_digit 4
check_digit_scheme 5
assigning_authority 6.1
assigning_authority_universal_id 6.2
assigning_authority_universal_id_type 6.3
id_type_code 7
assigning_facility 8.1
assigning_facility_universal_id 8.2
assigning_facility_universal_id_type 8.3
name_rep_code 9
identifier 10
""",
    "cx": """
id 1
check_digit 2
check_digit_scheme 3
assigning_authority 4.1
assigning_authority_universal_id 4.2
assigning_authority_universal_id_type 4.3
type_code 5
assigning_facility 6.1
assigning_facility_universal_id 6.2
assigning_facility_universal_id_type 6.3
effective_date 7
expiration_date 8
assigning_jurisdiction 9
assigning_agency 10
security_check 11
security_check_scheme 12
""",
    "xad": """
street 1
other_designation 2
city 3
state 4
zip 5
country 6
type 7
other_geographic 8
county_parish_code 9.1
county_parish_text 9.2
county_parish_coding_system 9.3
census_tract 10.1
census_tract_text 10.2
census_tract_coding_system 10.3
representation_code 11
effective_date 13
expiration_date 14
expiration_reason 15.1
expiration_reason_text 15.2
expiration_reason_coding_system 15.3
temporary_indicator 16
bad_address_indicator 17
usage 18
addressee 19
comment 20
preference_order 21
protection_code 22.1
protection_code_text 22.2
protection_code_coding_system 22.3
identifier 23.1
""",
    "mo": """
amount 1
currency 2
""",
    "og": """
sub_identifier 1
group 2
sequence 3
identifier 4
""",
}

# Segments that occur once per message, and envelope segments around batches.
SINGLE_SEGMENTS = ("MSH", "EVN", "PID", "PD1", "PV1", "PV2", "MRG", "SCH", "TXA")
ENVELOPE_SEGMENTS = ("FHS", "BHS", "BTS", "FTS")

# Fields of the built-in segment tables.
SEGMENTS = {
    "MSH": """
1 st field_separator
2 st encoding_characters
3.1 st sending_application
3.2 st sending_application_universal_id
3.3 st sending_application_universal_id_type
4.1 st sending_facility
4.2 st sending_facility_universal_id
4.3 st sending_facility_universal_id_type
5.1 st receiving_application
5.2 st receiving_application_universal_id
5.3 st receiving_application_universal_id_type
6.1 st receiving_facility
6.2 st receiving_facility_universal_id
6.3 st receiving_facility_universal_id_type
7 dtm message_datetime
8 st security
9.1 st message_code
9.2 st trigger_event
9.3 st message_structure
10 st message_control_id
11 pt processing_id
12 vid version_id
13 int sequence_number
14 st continuation_pointer
15 st accept_acknowledgment_type
16 st application_acknowledgment_type
17 st country_code
18 id* character_set
19 cwe principal_language
20 st alt_character_set_handling
21 ei* message_profile_identifiers
22 xon sending_responsible_org
23 xon receiving_responsible_org
24 hd sending_network_address
25 hd receiving_network_address
26 cwe security_classification_tag
27 cwe* security_handling_instructions
28 cwe* special_access_restriction
""",
    "PID": """
1 int set_id
2 cx patient_external_id
3 cx* patient_id
4 cx alternate_patient_id
5 xpn* patient_names
6 xpn* mothers_maiden_names
7 dtm date_of_birth
8 cwe administrative_sex
9 st1 patient_alias
10 cwe* race
11 xad* address
12 st county_code
13 xtn* home_phone
14 xtn* business_phone
15 cwe primary_language
16 cwe marital_status
17 cwe religion
18 cx patient_account_number
19 st ssn
20 dln drivers_license
21 cx* mothers_identifier
22 cwe* ethnic_group
23 st birth_place
24 st multiple_birth_indicator
25 int birth_order
26 cwe* citizenship
27 cwe veterans_military_status
28 cwe nationality
29 dtm patient_death_datetime
30 st patient_death_indicator
31 st identity_unknown_indicator
32 cwe* identity_reliability_code
33 dtm last_update_datetime
34 hd last_update_facility
35 cwe species_code
36 cwe breed_code
37 st strain
38 cwe production_class_code
39 cwe* tribal_citizenship
40 xtn* patient_telecom
""",
    "PV1": """
1 int set_id
2 cwe patient_class
3 pl assigned_patient_location
4 cwe admission_type
5 cx preadmit_number
6 pl prior_patient_location
7 xcn* attending_doctor
8 xcn* referring_doctor
9 xcn* consulting_doctor
10 cwe hospital_service
11 pl temporary_location
12 cwe preadmit_test_indicator
13 cwe readmission_indicator
14 cwe admit_source
15 cwe* ambulatory_status
16 cwe vip_indicator
17 xcn* admitting_doctor
18 cwe patient_type
19 cx visit_number
20 fc* financial_class
21 cwe charge_price_indicator
22 cwe courtesy_code
23 cwe credit_rating
24 cwe* contract_code
25 dtm* contract_effective_date
26 s* contract_amount
27 s* contract_period
28 cwe interest_code
29 cwe transfer_to_bad_debt_code
30 dtm transfer_to_bad_debt_date
31 cwe bad_debt_agency_code
32 st bad_debt_transfer_amount
33 st bad_debt_recovery_amount
34 cwe delete_account_indicator
35 dtm delete_account_date
36 cwe discharge_disposition
37 dld discharged_to_location
38 cwe diet_type
39 cwe servicing_facility
40 cwe bed_status
41 cwe account_status
42 pl pending_location
43 pl prior_temporary_location
44 dtm1 admit_datetime
45 dtm1 discharge_datetime
46 st current_patient_balance
47 st total_charges
48 st total_adjustments
49 st total_payments
50 cx* alternate_visit_id
51 cwe visit_indicator
52 xcn* other_healthcare_provider
53 st service_episode_description
54 cx service_episode_identifier
""",
    "OBR": """
1 set set_id
2 ei placer_order_number
3 ei filler_order_number
4 cwe service
5 st priority
6 dtm requested_datetime
7 dtm observation_datetime
8 dtm observation_end_datetime
9 cq collection_volume
10 xcn* collector
11 st specimen_action_code
12 cwe danger_code
13 cwe* relevant_clinical_information
14 dtm specimen_received_datetime
15 sps specimen_source
16 xcn* ordering_provider
17 xtn* order_callback_phone
18 st placer_field_1
19 st placer_field_2
20 st filler_field_1
21 st filler_field_2
22 dtm results_rpt_status_chng_datetime
23 moc charge_to_practice
24 st diagnostic_service_section
25 st result_status
26 prl parent_result
27 tq* quantity_timing
28 xcn* result_copies_to
29 eip parent_results_observation_identifier
30 st transportation_mode
31 cwe* reason_for_study
32 ndl principal_result_interpreter
33 ndl* assistant_result_interpreter
34 ndl* technician
35 ndl* transcriptionist
36 dtm scheduled_datetime
37 int number_of_sample_containers
38 cwe* transport_logistics
39 cwe* collectors_comment
40 cwe transport_arrangement_responsibility
41 st transport_arranged
42 st escort_required
43 cwe* planned_patient_transport_comment
44 cwe procedure_code
45 cwe* procedure_code_modifier
46 cwe* placer_supplemental_service_info
47 cwe* filler_supplemental_service_info
48 cwe medically_necessary_dup_proc_reason
49 cwe result_handling
50 cwe parent_universal_service_id
51 ei observation_group
52 ei parent_observation_group
53 cx* alternate_placer_order
54 eip* parent_order
55 st action_code
""",
    "OBX": """
1 set set_id
2 st value_type
3 cwe observation_id
4 og observation_sub_id
5 s* observation_value
6 cwe units
7 st references_range
8 cwe* interpretation_codes
9 st probability
10 id* nature_of_abnormal_test
11 st observation_result_status
12 dtm effective_date_of_ref_range
13 st user_defined_access_checks
14 dtm datetime_of_observation
15 cwe producers_id
16 xcn* responsible_observer
17 cwe* observation_method
18 ei* equipment_instance_identifier
19 dtm datetime_of_analysis
20 cwe* observation_site
21 ei observation_instance_identifier
22 cwe mood_code
23 xon performing_organization
24 xad performing_org_address
25 xcn1 performing_org_medical_director
26 st patient_results_release_category
27 cwe root_cause
28 cwe* local_process_control
29 st observation_type
30 st observation_sub_type
31 st action_code
32 cwe* observation_value_absent_reason
33 eip* observation_related_specimen
""",
    "AL1": """
1 set set_id
2 cwe allergen_type_code
3 cwe allergen_code
4 cwe allergy_severity_code
5 cwe* allergy_reaction
6 dtm identification_date
""",
    "DG1": """
1 set set_id
2 st diagnosis_coding_method
3 cwe diagnosis_code
4 st diagnosis_description
5 dtm diagnosis_datetime
6 cwe diagnosis_type
7 cwe major_diagnostic_category
8 cwe diagnostic_related_group
9 st drg_approval_indicator
10 cwe drg_grouper_review_code
11 cwe outlier_type
12 int outlier_days
13 cp outlier_cost
14 st grouper_version_and_type
15 int diagnosis_priority
16 xcn* diagnosing_clinician
17 cwe diagnosis_classification
18 st confidential_indicator
19 dtm attestation_datetime
20 ei diagnosis_identifier
21 st diagnosis_action_code
22 ei parent_diagnosis
23 cwe drg_ccl_value_code
24 st drg_grouping_usage
25 cwe drg_diagnosis_determination_status
26 cwe present_on_admission_indicator
""",
    "NK1": """
1 set set_id
2 xpn* names
3 cwe relationship
4 xad* address
5 xtn* phone_number
6 xtn* business_phone
7 cwe contact_role
8 dtm start_date
9 dtm end_date
10 st job_title
11 jcc job_code
12 cx employee_number
13 xon* organization_name
14 cwe marital_status
15 cwe administrative_sex
16 dtm date_of_birth
17 cwe* living_dependency
18 cwe* ambulatory_status
19 cwe* citizenship
20 cwe primary_language
21 cwe living_arrangement
22 cwe publicity_code
23 st protection_indicator
24 cwe student_indicator
25 cwe religion
26 xpn* mothers_maiden_names
27 cwe nationality
28 cwe* ethnic_group
29 cwe* contact_reason
30 xpn* contact_persons
31 xtn* contact_person_telephone
32 xad* contact_persons_address
33 cx* associated_party_identifiers
34 cwe job_status
35 cwe* race
36 cwe handicap
37 st contact_ssn
38 st birth_place
39 cwe vip_indicator
40 xtn1 telecommunication_info
41 xtn1 contact_telecommunication_info
""",
    "EVN": """
1 st event_type_code
2 dtm recorded_datetime
3 dtm date_time_planned_event
4 cwe event_reason
5 xcn* operator
6 dtm event_occurred
7 hd event_facility
""",
    "PD1": """
1 cwe* living_dependency
2 cwe living_arrangement
3 xon* patient_primary_facility
4 xcn1 patient_primary_care_provider
5 cwe student_indicator
6 cwe handicap
7 cwe living_will_code
8 cwe organ_donor_code
9 st separate_bill
10 cx* duplicate_patient
11 cwe publicity_code
12 st protection_indicator
13 dtm protection_indicator_effective_date
14 xon* place_of_worship
15 cwe* advance_directive_code
16 cwe immunization_registry_status
17 dtm immunization_registry_status_effective_date
18 dtm publicity_code_effective_date
19 cwe military_branch
20 cwe military_rank_grade
21 cwe military_status
22 dtm advance_directive_last_verified_date
23 dtm retirement_date
""",
    "PV2": """
1 pl prior_pending_location
2 cwe accommodation_code
3 cwe admit_reason
4 cwe transfer_reason
5 s* patient_valuables
6 st patient_valuables_location
7 cwe* visit_user_code
8 dtm expected_admit_datetime
9 dtm expected_discharge_datetime
10 int estimated_length_of_inpatient_stay
11 int actual_length_of_inpatient_stay
12 st visit_description
13 xcn* referral_source
14 dtm previous_service_date
15 st employment_illness_related_indicator
16 cwe purge_status_code
17 dtm purge_status_date
18 cwe special_program_code
19 st retention_indicator
20 int expected_number_of_insurance_plans
21 cwe visit_publicity_code
22 st visit_protection_indicator
23 xon* clinic_organization
24 cwe patient_status_code
25 cwe visit_priority_code
26 dtm previous_treatment_date
27 cwe expected_discharge_disposition
28 dtm signature_on_file_date
29 dtm first_similar_illness_date
30 cwe patient_charge_adjustment_code
31 cwe recurring_service_code
32 st billing_media_code
33 dtm expected_surgery_datetime
34 st military_partnership_code
35 st military_non_availability_code
36 st newborn_baby_indicator
37 st baby_detained_indicator
38 cwe mode_of_arrival_code
39 cwe* recreational_drug_use_code
40 cwe admission_level_of_care_code
41 cwe* precaution_code
42 cwe patient_condition_code
43 cwe living_will_code
44 cwe organ_donor_code
45 cwe* advance_directive_code
46 dtm patient_status_effective_date
47 dtm expected_loa_return_datetime
48 dtm expected_preadmission_testing_datetime
49 cwe* notify_clergy_code
50 dtm advance_directive_last_verified_date
""",
    "MRG": """
1 cx* prior_patient_id
2 cx* prior_alternate_patient_id
3 cx prior_patient_account_number
4 cx prior_patient_id_external
5 cx prior_visit_number
6 cx prior_alternate_visit_id
7 xpn* prior_patient_names
""",
    "IAM": """
1 set set_id
2 cwe allergen_type_code
3 cwe allergen_code
4 cwe allergy_severity_code
5 cwe* allergy_reaction
6 cwe allergy_action_code
7 ei allergy_unique_identifier
8 st action_reason
9 cwe sensitivity_to_causative_agent_code
10 cwe allergen_group_code
11 dtm onset_date
12 st onset_date_text
13 dtm reported_datetime
14 xcn reported_by
15 cwe relationship_to_patient_code
16 cwe alert_device_code
17 cwe allergy_clinical_status_code
18 xcn statused_by_person
19 xon statused_by_organization
20 dtm statused_at_datetime
21 xcn inactivated_by_person
22 dtm inactivated_datetime
23 xcn initially_recorded_by_person
24 dtm initially_recorded_datetime
25 xcn modified_by_person
26 dtm modified_datetime
27 cwe clinician_identified_allergen_code
28 xon initially_recorded_by_organization
29 xon modified_by_organization
30 xon inactivated_by_organization
""",
    "PR1": """
1 set set_id
2 st procedure_coding_method
3 cwe procedure_code
4 st procedure_description
5 dtm procedure_datetime
6 cwe procedure_functional_type
7 int procedure_minutes
8 xcn* anesthesiologist
9 cwe anesthesia_code
10 int anesthesia_minutes
11 xcn* surgeon
12 xcn* procedure_practitioner
13 cwe consent_code
14 st procedure_priority
15 cwe associated_diagnosis_code
16 cwe* procedure_code_modifier
17 cwe procedure_drg_type
18 cwe* tissue_type_code
19 ei procedure_identifier
20 st procedure_action_code
21 cwe drg_procedure_determination_status
22 cwe drg_procedure_relevance
23 pl* treating_organizational_unit
24 st respiratory_within_surgery
25 ei parent_procedure_id
""",
    "ORC": """
1 st order_control
2 ei placer_order_number
3 ei filler_order_number
4 ei placer_group_number
5 st order_status
6 st response_flag
7 tq* quantity_timing
8 eip* parent_order
9 dtm datetime_of_transaction
10 xcn* entered_by
11 xcn* verified_by
12 xcn* ordering_provider
13 pl enterers_location
14 xtn* call_back_phone
15 dtm order_effective_datetime
16 cwe order_control_code_reason
17 cwe entering_organization
18 cwe entering_device
19 xcn* action_by
20 cwe advanced_beneficiary_notice_code
21 xon* ordering_facility_name
22 xad* ordering_facility_address
23 xtn* ordering_facility_phone
24 xad* ordering_provider_address
25 cwe order_status_modifier
26 cwe abn_override_reason
27 dtm fillers_expected_availability_datetime
28 cwe confidentiality_code
29 cwe order_type
30 cwe enterer_authorization_mode
31 cwe parent_universal_service_id
32 dtm advanced_beneficiary_notice_date
33 cx* alternate_placer_order_number
34 cwe* order_workflow_profile
35 st action_code
36.1 dtm order_status_date_range_start
36.2 dtm order_status_date_range_end
37 dtm order_creation_datetime
38 ei filler_order_group_number
""",
    "NTE": """
1 set set_id
2 st source_of_comment
3 s* comment
4 cwe comment_type
5 xcn entered_by
6 dtm entered_datetime
7 dtm effective_start_date
8 dtm expiration_date
9 cwe* coded_comment
""",
    "SPM": """
1 set set_id
2 eip specimen_id
3 eip* specimen_parent_ids
4 cwe specimen_type
5 cwe* specimen_type_modifier
6 cwe* specimen_additives
7 cwe specimen_collection_method
8 cwe specimen_source_site
9 cwe* specimen_source_site_modifier
10 cwe specimen_collection_site
11 cwe* specimen_role
12 cq specimen_collection_amount
13 int grouped_specimen_count
14 s* specimen_description
15 cwe* specimen_handling_code
16 cwe* specimen_risk_code
17.1 dtm specimen_collection_datetime_start
17.2 dtm specimen_collection_datetime_end
18 dtm specimen_received_datetime
19 dtm specimen_expiration_datetime
20 st specimen_availability
21 cwe* specimen_reject_reason
22 cwe specimen_quality
23 cwe specimen_appropriateness
24 cwe* specimen_condition
25 cq specimen_current_quantity
26 int number_of_specimen_containers
27 cwe container_type
28 cwe container_condition
29 cwe specimen_child_role
30 cx* accession_id
31 cx* other_specimen_id
32 ei shipment_id
33 dtm culture_start_datetime
34 dtm culture_final_datetime
35 st action_code
""",
    "IN1": """
1 set set_id
2 cwe insurance_plan
3 cx* insurance_company
4 xon* insurance_company_name
5 xad* insurance_company_address
6 xpn* insurance_co_contacts
7 xtn* insurance_co_phone_number
8 st group_number
9 xon* group_name
10 cx* insureds_group_emp
11 xon* insureds_group_emp_name
12 dtm plan_effective_date
13 dtm plan_expiration_date
14 aui authorization_information
15 cwe plan_type
16 xpn* insured_names
17 cwe insureds_relationship_to_patient
18 dtm insureds_date_of_birth
19 xad* insureds_address
20 cwe assignment_of_benefits
21 cwe coordination_of_benefits
22 st coord_of_ben_priority
23 st notice_of_admission_flag
24 dtm notice_of_admission_date
25 st report_of_eligibility_flag
26 dtm report_of_eligibility_date
27 cwe release_information_code
28 st pre_admit_cert
29 dtm verification_datetime
30 xcn* verification_by
31 cwe type_of_agreement_code
32 cwe billing_status
33 int lifetime_reserve_days
34 int delay_before_lr_day
35 cwe company_plan_code
36 st policy_number
37 cp policy_deductible
38 cp policy_limit_amount
39 int policy_limit_days
40 cp room_rate_semi_private
41 cp room_rate_private
42 cwe insureds_employment_status
43 cwe insureds_administrative_sex
44 xad* insureds_employers_address
45 st verification_status
46 cwe prior_insurance_plan_id
47 cwe coverage_type
48 cwe handicap
49 cx* insureds_id_number
50 cwe signature_code
51 dtm signature_code_date
52 st insureds_birth_place
53 cwe vip_indicator
54 cwe* external_health_plan_identifiers
55 st insurance_action_code
""",
    "GT1": """
1 set set_id
2 cx* guarantor_number
3 xpn* guarantor_names
4 xpn* guarantor_spouse_names
5 xad* guarantor_address
6 xtn* guarantor_ph_num_home
7 xtn* guarantor_ph_num_business
8 dtm guarantor_date_of_birth
9 cwe guarantor_administrative_sex
10 cwe guarantor_type
11 cwe guarantor_relationship
12 st guarantor_ssn
13 dtm guarantor_date_begin
14 dtm guarantor_date_end
15 int guarantor_priority
16 xpn* guarantor_employer_names
17 xad* guarantor_employer_address
18 xtn* guarantor_employer_phone_number
19 cx* guarantor_employee_id_number
20 cwe guarantor_employment_status
21 xon* guarantor_organization_name
22 st guarantor_billing_hold_flag
23 cwe guarantor_credit_rating_code
24 dtm guarantor_death_date_and_time
25 st guarantor_death_flag
26 cwe guarantor_charge_adjustment_code
27 cp guarantor_household_annual_income
28 int guarantor_household_size
29 cx* guarantor_employer_id_number
30 cwe guarantor_marital_status_code
31 dtm guarantor_hire_effective_date
32 dtm employment_stop_date
33 cwe living_dependency
34 cwe* ambulatory_status
35 cwe* citizenship
36 cwe primary_language
37 cwe living_arrangement
38 cwe publicity_code
39 st protection_indicator
40 cwe student_indicator
41 cwe religion
42 xpn* mothers_maiden_names
43 cwe nationality
44 cwe* ethnic_group
45 xpn* contact_persons
46 xtn* contact_persons_telephone_number
47 cwe contact_reason
48 cwe contact_relationship
49 st job_title
50 jcc job_code_class
51 xon* guarantor_employers_org_name
52 cwe handicap
53 cwe job_status
54 fc guarantor_financial_class
55 cwe* guarantor_race
56 st guarantor_birth_place
57 cwe vip_indicator
""",
    "FT1": """
1 set set_id
2 cx transaction_id
3 st transaction_batch_id
4.1 dtm transaction_date_start
4.2 dtm transaction_date_end
5 dtm transaction_posting_date
6 cwe transaction_type
7 cwe transaction_code
8 st transaction_description
9 st transaction_description_alt
10 int transaction_quantity
11 cp transaction_amount_extended
12 cp transaction_amount_unit
13 cwe department_code
14 cwe insurance_plan_id
15 cp insurance_amount
16 pl assigned_patient_location
17 cwe fee_schedule
18 cwe patient_type
19 cwe* diagnosis_code
20 xcn* performed_by
21 xcn* ordered_by
22 cp unit_cost
23 ei filler_order_number
24 xcn* entered_by
25 cwe procedure_code
26 cwe* procedure_code_modifier
27 cwe advanced_beneficiary_notice_code
28 cwe medically_necessary_dup_proc_reason
29 cwe ndc_code
30 cx payment_reference_id
31 s* transaction_reference_key
32 xon* performing_facility
33 xon1 ordering_facility
34 cwe item_number
35 st model_number
36 cwe* special_processing_code
37 cwe clinic_code
38 cx referral_number
39 cx authorization_number
40 cwe service_provider_taxonomy_code
41 cwe revenue_code
42 st prescription_number
43 cq ndc_qty_and_uom
44 cwe dme_certificate_of_medical_necessity_transmission_code
45 cwe dme_certification_type_code
46 st dme_duration_value
47 st dme_certification_revision_date
48 st dme_initial_certification_date
49 st dme_last_certification_date
50 st dme_length_of_medical_necessity_days
51 mo dme_rental_price
52 mo dme_purchase_price
53 cwe dme_frequency_code
54 st dme_certification_condition_indicator
55 cwe* dme_condition_indicator_code
56 cwe service_reason_code
""",
    "RXA": """
1 set set_id
2 int administration_sub_id_counter
3 dtm datetime_start_of_administration
4 dtm datetime_end_of_administration
5 cwe administered_code
6 st administered_amount
7 cwe administered_units
8 cwe administered_dosage_form
9 cwe* administration_notes
10 xcn* administering_provider
11 st administered_at_location
12 st administered_per_time_unit
13 st administered_strength
14 cwe administered_strength_units
15 s* substance_lot_number
16 dtm* substance_expiration_date
17 cwe* substance_manufacturer_name
18 cwe* substance_treatment_refusal_reason
19 cwe* indication
20 st completion_status
21 st action_code_rxa
22 dtm system_entry_datetime
23 st administered_drug_strength_volume
24 cwe administered_drug_strength_volume_units
25 cwe administered_barcode_identifier
26 st pharmacy_order_type
27 pl administer_at
28 xad administered_at_address
29 ei* administered_tag_identifier
""",
    "SCH": """
1 ei placer_appointment_id
2 ei filler_appointment_id
3 int occurrence_number
4 ei placer_group_number
5 cwe schedule_id
6 cwe event_reason
7 cwe appointment_reason
8 cwe appointment_type
9 int appointment_duration
10 cwe appointment_duration_units
11 st1 appointment_timing_quantity
12 xcn* placer_contact_person
13 xtn placer_contact_phone
14 xad* placer_contact_address
15 pl placer_contact_location
16 xcn* filler_contact_person
17 xtn filler_contact_phone
18 xad* filler_contact_address
19 pl filler_contact_location
20 xcn* entered_by_person
21 xtn* entered_by_phone_number
22 pl entered_by_location
23 ei parent_placer_appointment_id
24 ei parent_filler_appointment_id
25 cwe filler_status_code
26 ei* placer_order_number
27 ei* filler_order_number
28 eip alternate_placer_order_group_number
""",
    "TXA": """
1 set set_id
2 cwe document_type
3 st document_content_presentation
4 dtm activity_datetime
5 xcn* primary_activity_provider
6 dtm origination_datetime
7 dtm transcription_datetime
8 dtm* edit_datetime
9 xcn* originator
10 xcn* assigned_document_authenticator
11 xcn* transcriptionist
12 ei unique_document_number
13 ei parent_document_number
14 ei* placer_order_number
15 ei filler_order_number
16 st unique_document_file_name
17 st document_completion_status
18 st document_confidentiality_status
19 st document_availability_status
20 st document_storage_status
21 st document_change_reason
22 xcn* authentication_person_time_stamp
23 xcn* distributed_copies
24 cwe* folder_assignment
25 s* document_title
26 dtm agreed_due_datetime
27 hd creating_facility
28 cwe creating_specialty
""",
}
