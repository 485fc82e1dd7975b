"""Words and patterns by which sample labels are put into categories."""

# For each category its exact words, its keywords and its patterns, in order of precedence.
CATEGORIES = [
    ("External_sample_id", "patient_id sample_id donor_id subject_id", "patient id|sample id|donor id|subject id", "patient|id|sample|donor|subject|barcode|participant|individual|controlid|patientid|subjectid|sampleid", ".*id$ .*_id$ patient.* subject.* donor.*"),
    ("Biospecimen Organism", "species organism strain", "", "mouse|human|homo sapiens|mus musculus|host|background strain|mouse strain", ".*strain.* .*organism.*"),
    ("Biospecimen Type", "tissue cell blood serum organ", "cell type|celltype|tissue type", "lymphocyte|monocyte|macrophage|stem cell|biopsy|specimen|sample type|fluid|brain tissue|liver tissue", ".*tissue.* .*cell.* .*blood.*"),
    ("Biospecimen Age", "age day week month year time", "", "developmental stage|passage|age in|donor age|patient age|time point|timepoint", ".*age.* .*day.* .*time.* .*stage.*"),
    ("Biospecimen Sex", "sex gender male female", "", "donor sex|patient gender|cell sex|animal sex", ".*sex.* .*gender.*"),
    ("Biospecimen Race", "race ethnicity", "", "caucasian|asian|hispanic|ethnicity|donor race|donor ethnicity", ".*race.* .*ethnicity.* .*ethnic.*"),
    ("Biospecimen Disease Condition", "disease condition diagnosis cancer tumor infection", "", "disease state|disease status|clinical diagnosis|pathology|tumor type|cancer status|clinical condition", ".*disease.* .*tumor.* .*cancer.* .*diagnosis.* .*condition.*"),
    ("Treatment", "treatment drug therapy medication group control placebo", "", "drug treatment|therapy|intervention|compound|chemical|vaccine|antibody treatment|chemotherapy", ".*treatment.* .*drug.* .*therapy.* .*group.*"),
    ("Treatment Dosage Regimen", "dose dosage concentration duration", "", "treatment dose|drug dose|treatment duration|protocol|regimen|drug concentration", ".*dose.* .*dosage.* .*concentration.* .*duration.*"),
]

#: (category, exact matches, keywords, patterns), as the operators take them.
RULES = [(name, [*words.split(), *filter(None, phrases.split("|"))], keywords.split("|"), patterns.split()) for name, words, phrases, keywords, patterns in CATEGORIES]
