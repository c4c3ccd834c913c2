"""Folder names of old cases and where they go in the two folder templates."""

from __future__ import annotations

#: Normalized folder name, destination in Foreclosure, destination in FCRA, certainty.
FOLDERS = [
    ('correspondence', '04_Correspondence', None, 'clear'),
    ('general', '01_General', None, 'clear'),
    ('litigation', '03_Litigation', None, 'clear'),
    ('loss mitigation', '02_Loss Mitigation', None, 'clear'),
    ('bank statements', '02_Loss Mitigation/Bank Statements', None, 'clear'),
    ('bank statement', '02_Loss Mitigation/Bank Statements', None, 'clear'),
    ('mortgage statements', '02_Loss Mitigation/Mortgage Statements', None, 'clear'),
    ('mortgage statement', '02_Loss Mitigation/Mortgage Statements', None, 'clear'),
    ('pay stubs', '02_Loss Mitigation/Pay Stubs', None, 'clear'),
    ('paystubs', '02_Loss Mitigation/Pay Stubs', None, 'clear'),
    ('taxes', '02_Loss Mitigation/Taxes', None, 'clear'),
    ('utility bills', '02_Loss Mitigation/Utility Bills', None, 'clear'),
    ('orders', '03_Litigation/Orders', None, 'clear'),
    ('pleadings', '03_Litigation/Pleadings', None, 'clear'),
    ('documents from client', None, '01_Documents from client', 'clear'),
    ('fcra dispute', None, '02_FCRA Dispute', 'clear'),
    ('credit report', None, '02_FCRA Dispute/Credit Report', 'clear'),
    ('credit reports', None, '02_FCRA Dispute/Credit Report', 'clear'),
    ('dispute letters', None, '02_FCRA Dispute/Dispute Letters', 'clear'),
    ('identifying documents', None, '02_FCRA Dispute/Identifying Documents', 'clear'),
    ('amended complaint', None, '03_Complaint/Amended Complaint', 'clear'),
    ('complaint', '03_Litigation/Pleadings', '03_Complaint', 'clear'),
    ('answers', '03_Litigation/Pleadings', '05_Answers', 'clear'),
    ('discovery', '03_Litigation/Discovery', '07_Discovery', 'clear'),
    ('motions', '03_Litigation/Motions', '09_Motions', 'clear'),
    ('tax returns and w2', '02_Loss Mitigation/Taxes', None, 'clear'),
    ('tax returns w2', '02_Loss Mitigation/Taxes', None, 'clear'),
    ('w2 and tax returns', '02_Loss Mitigation/Taxes', None, 'clear'),
    ('income tax and w 2 s', '02_Loss Mitigation/Taxes', None, 'clear'),
    ('answer', '03_Litigation/Pleadings', '05_Answers', 'clear'),
    ('motion', '03_Litigation/Motions', '09_Motions', 'clear'),
    ('docs from client', '01_General', '01_Documents from client', 'clear'),
    ('documents from the client', '01_General', '01_Documents from client', 'clear'),
    ('loss mit', '02_Loss Mitigation', None, 'clear'),
    ('stipulation', None, '10_Stipulations', 'clear'),
    ('notice', None, '11_Notices', 'clear'),
    ('credit reports and disputes', None, '02_FCRA Dispute', 'clear'),
    ('discovery demands', '03_Litigation/Discovery', '07_Discovery', 'clear'),
    ('discovery responses', '03_Litigation/Discovery', '07_Discovery', 'clear'),
    ('depositions', '03_Litigation/Discovery', '08_Depositions', 'proposed'),
    ('deposition', '03_Litigation/Discovery', '08_Depositions', 'proposed'),
    ('notices of deposition', '03_Litigation/Discovery', '08_Depositions/Notices of Deposition', 'proposed'),
    ('fcra package', None, '02_FCRA Dispute', 'proposed'),
    ('notice of dispute', None, '02_FCRA Dispute/Dispute Letters', 'clear'),
    ('dispute letter', None, '02_FCRA Dispute/Dispute Letters', 'clear'),
    ('notice of settlement', '03_Litigation', '11_Notices/Notice of Settlement', 'clear'),
    ('notice of appearance', '03_Litigation', '11_Notices/Notice of Appearance', 'clear'),
    ('request for default', '03_Litigation/Motions', '09_Motions', 'proposed'),
    ('id ss statement', None, '02_FCRA Dispute/Identifying Documents', 'proposed'),
    ('rule 26 initial disclosures', '03_Litigation/Discovery', '06_Case Management Plan Initial Conference/Rule 26(a)(1)', 'clear'),
    ('initial disclosures', '03_Litigation/Discovery', '06_Case Management Plan Initial Conference/Rule 26(a)(1)', 'clear'),
    ('subpoenas', '03_Litigation/Discovery', '07_Discovery', 'clear'),
    ('subpoena', '03_Litigation/Discovery', '07_Discovery', 'clear'),
    ('expert witness', '03_Litigation/Discovery', '07_Discovery', 'proposed'),
    ('status report', '01_General', '13_Status Reports', 'clear'),
    ('drop letter', '03_Litigation', '11_Notices/Notice of Dismissal', 'proposed'),
    ('dismissal', '03_Litigation', '11_Notices/Notice of Dismissal', 'proposed'),
    ('discontinuance', '03_Litigation', '11_Notices/Notice of Dismissal', 'proposed'),
    ('notices', '03_Litigation', '11_Notices', 'proposed'),
    ('service of process', '03_Litigation/Pleadings', '04_Service of Process', 'clear'),
    ('stipulations', '03_Litigation', '10_Stipulations', 'clear'),
    ('settlement documents', '01_General', '12_Settlement Documents', 'proposed'),
    ('billing and invoices', '01_General', '14_Billing and Invoices', 'proposed'),
    ('case management plan initial conference', '03_Litigation', '06_Case Management Plan Initial Conference', 'clear'),
    ('status reports', '01_General', '13_Status Reports', 'clear'),
    ('mortgage statments', '02_Loss Mitigation/Mortgage Statements', None, 'clear'),
    ('court documents', '03_Litigation', None, 'proposed'),
    ('retainer', '01_General', '01_Documents from client', 'clear'),
    ('title', '01_General', None, 'proposed'),
    ('faxed', '01_General', None, 'proposed'),
    ('trial', '03_Litigation', None, 'proposed'),
    ('3rd party bills', '02_Loss Mitigation', None, 'proposed'),
    ('third party bills', '02_Loss Mitigation', None, 'proposed'),
    ('court docs', '03_Litigation', None, 'proposed'),
    ('osc', '03_Litigation/Motions', '09_Motions', 'proposed'),
    ('osc withdraw', '03_Litigation/Motions', '09_Motions', 'proposed'),
    ('osc to withdraw', '03_Litigation/Motions', '09_Motions', 'proposed'),
    ('tro', '03_Litigation/Motions', '09_Motions', 'proposed'),
    ('affidavits of service', '03_Litigation/Pleadings', '04_Service of Process', 'proposed'),
    ('affidavit of service', '03_Litigation/Pleadings', '04_Service of Process', 'proposed'),
    ('signed docs', '01_General', '01_Documents from client', 'proposed'),
    ('liens judgments', '01_General', None, 'proposed'),
    ('liens judgements', '01_General', None, 'proposed'),
    ('fcra', None, '02_FCRA Dispute', 'proposed'),
    ('notices of dispute', None, '02_FCRA Dispute/Dispute Letters', 'proposed'),
    ('appeal', '03_Litigation', '11_Notices/Notice of Appeal', 'proposed'),
    ('autho', '01_General', '01_Documents from client', 'proposed'),
    ('settlement', '01_General', '12_Settlement Documents', 'proposed'),
    ('financial worksheet and hardship letter', '02_Loss Mitigation', None, 'proposed'),
    ('hoa insurance utility re taxes', '02_Loss Mitigation', None, 'proposed'),
    ('hoa insurance utility and re taxes', '02_Loss Mitigation', None, 'proposed'),
    ('self employed p l', '02_Loss Mitigation', None, 'proposed'),
    ('submission', '02_Loss Mitigation', None, 'proposed'),
    ('submissions', '02_Loss Mitigation', None, 'proposed'),
    ('submission new', '02_Loss Mitigation', None, 'proposed'),
    ('submission 2', '02_Loss Mitigation', None, 'proposed'),
    ('old submission', '02_Loss Mitigation', None, 'proposed'),
    ('short sale', '02_Loss Mitigation', None, 'proposed'),
    ('prior case', '01_General', None, 'proposed'),
    ('prior foreclosure', '01_General', None, 'proposed'),
    ('old docs', '01_General', None, 'proposed'),
    ('leases', '01_General', None, 'proposed'),
    ('faxes', '01_General', None, 'proposed'),
    ('recordings', None, None, 'ASK'),
    ('recording', None, None, 'ASK'),
    ('arbitration', None, None, 'ASK'),
    ('scanned', None, None, 'ASK'),
    ('bankruptcy', None, None, 'ASK'),
    ('qwr', None, None, 'ASK'),
    ('qwr federal', None, None, 'ASK'),
    ('article 15', None, None, 'ASK'),
    ('federal action fee', None, None, 'ASK'),
]

#: Pattern on the normalized name, destinations, certainty; the first that matches counts.
FOLDER_PATTERNS = [
    (r"\bmsj\b|summary judgment", '03_Litigation/Motions', '09_Motions', 'proposed'),
    (r"\bmotion to\b|\bopp(osition)? to\b|\bcross[- ]?motion\b", '03_Litigation/Motions', '09_Motions', 'proposed'),
    (r"\bdepo(sition)?s?\b", '03_Litigation/Discovery', '08_Depositions', 'proposed'),
    (r"\bdiscovery\b|\binterrogator", '03_Litigation/Discovery', '07_Discovery', 'proposed'),
    (r"\bemails?\b|\bletters?\b|\bcorrespondence\b", '04_Correspondence', None, 'proposed'),
    (r"\bsubmissions?\b", '02_Loss Mitigation', None, 'proposed'),
    (r"\bappeals?\b|\bappellate\b", '03_Litigation', '11_Notices/Notice of Appeal', 'proposed'),
    (r"\bmotions?\b|\bosc\b|\btro\b", '03_Litigation/Motions', '09_Motions', 'proposed'),
    (r"\bnotes\b", '01_General', '01_Documents from client', 'proposed'),
    (r"\bmodifications?\b|\bhamp\b|\bhardship\b", '02_Loss Mitigation', None, 'proposed'),
    (r"\bbankruptcy\b|\bbk\b", None, None, 'ASK'),
    (r"\bqwr\b", None, None, 'ASK'),
    (r"\barticle 15\b", None, None, 'ASK'),
    (r"\bfederal action\b", None, None, 'ASK'),
    (r"\bscanned\b|\bscans?\b", None, None, 'ASK'),
    (r"\bl ?& ?t\b|landlord", None, None, 'ASK'),
    (r"\bprior\b|\bold file\b|\bold docs?\b", '01_General', None, 'proposed'),
]

#: The folder paths of each template.
TEMPLATES = {
    'Foreclosure': [
        '01_General',
        '02_Loss Mitigation',
        '02_Loss Mitigation/Bank Statements',
        '02_Loss Mitigation/Mortgage Statements',
        '02_Loss Mitigation/Pay Stubs',
        '02_Loss Mitigation/Taxes',
        '02_Loss Mitigation/Utility Bills',
        '03_Litigation',
        '03_Litigation/Discovery',
        '03_Litigation/Motions',
        '03_Litigation/Orders',
        '03_Litigation/Pleadings',
        '04_Correspondence',
    ],
    'FCRA': [
        '01_Documents from client',
        '02_FCRA Dispute',
        '02_FCRA Dispute/Credit Report',
        '02_FCRA Dispute/Dispute Letters',
        '02_FCRA Dispute/Identifying Documents',
        '03_Complaint',
        '03_Complaint/Amended Complaint',
        '04_Service of Process',
        '05_Answers',
        '06_Case Management Plan Initial Conference',
        '06_Case Management Plan Initial Conference/Rule 26(a)(1)',
        '06_Case Management Plan Initial Conference/Rule 26(a)(1)/Defendant Rule 26(a)(1)',
        '07_Discovery',
        '07_Discovery/Defendant Expert Witness Report',
        '07_Discovery/Defendants Demands',
        '07_Discovery/Deficiency Letters',
        '07_Discovery/Plaintiff Demands',
        '07_Discovery/Plaintiff Expert Witness Report',
        '07_Discovery/Responses to Defendants Demands',
        '07_Discovery/Responses to Plaintiff Demands',
        '08_Depositions',
        '08_Depositions/Notices of Deposition',
        '09_Motions',
        '09_Motions/Adjournment Requests',
        '09_Motions/Pro Hac Vice Motions',
        '09_Motions/Rule 12',
        '09_Motions/Rule 12/Defendants Rule 12 Motion',
        '09_Motions/Rule 12/Defendants Rule 12 PMC Letter',
        '09_Motions/Rule 12/Plaintiff Response to 12 Motion',
        '09_Motions/Rule 12/Plaintiff Response to Rule 12 PMC Letter',
        '10_Stipulations',
        '10_Stipulations/Extension of Time',
        '10_Stipulations/Voluntary Dismissal',
        '11_Notices',
        '11_Notices/Notice of Appeal',
        '11_Notices/Notice of Appearance',
        '11_Notices/Notice of Dismissal',
        '11_Notices/Notice of Settlement',
        '12_Settlement Documents',
        '12_Settlement Documents/Ex-Parte Settlement Letter',
        '12_Settlement Documents/Itemized Damages to Defendants',
        '13_Status Reports',
        '14_Billing and Invoices',
    ],
}
