"""Document types: ordered rules that tell a type from a name or a text.

A rule table is a parameter of the classifier; this is the default one.
"""

from __future__ import annotations

#: Name, pattern, folder in the Foreclosure template, folder in the FCRA template, certainty,
#: pattern for file names (None: the same), whether the type only says the medium. The order is the tie-break.
DOC_TYPES = [
    ('Response to PMC letter', 'response to .{0,25}pre-?motion conference|response .{0,20}pmc letter', '03_Litigation/Motions', '09_Motions/Rule 12/Plaintiff Response to Rule 12 PMC Letter', 'proposed', None, False),
    ('Pre-motion conference letter', 'pre-?motion conference (letter|request)|request .{0,25}pre-?motion conference', '03_Litigation/Motions', '09_Motions/Rule 12/Defendants Rule 12 PMC Letter', 'proposed', None, False),
    ('Opposition to motion to dismiss', '(opposition|response) to .{0,40}motion to dismiss|memorandum of law in opposition', '03_Litigation/Motions', '09_Motions/Rule 12/Plaintiff Response to 12 Motion', 'proposed', None, False),
    ('Rule 12 motion to dismiss', r"rule 12\s*\(\s*b\s*\)|motion to dismiss the (amended )?complaint|12\(b\)\(6\)", '03_Litigation/Motions', '09_Motions/Rule 12/Defendants Rule 12 Motion', 'proposed', None, False),
    ('Pro hac vice motion', 'pro hac vice', '03_Litigation/Motions', '09_Motions/Pro Hac Vice Motions', 'clear', None, False),
    ('Adjournment request', 'request .{0,25}adjourn|letter motion .{0,25}adjourn|adjournment request', '03_Litigation/Motions', '09_Motions/Adjournment Requests', 'proposed', None, False),
    ('Amended complaint', 'amended (verified )?complaint', '03_Litigation/Pleadings', '03_Complaint/Amended Complaint', 'clear', r"amended complaint|\bamd\.? ?compl", False),
    ('Summons and complaint', 'summons (and|&) (verified )?complaint|you are hereby summoned', '03_Litigation/Pleadings', '03_Complaint', 'clear', r"summons|\bs ?& ?c\b", False),
    ('Request for preliminary conference', r"request for (a )?preliminary conference|requests? a preliminary conference|request for judicial intervention|\brji\b", '03_Litigation', '06_Case Management Plan Initial Conference', 'clear', r"prelim\w* conf|\brji\b|request for judicial", False),
    ('Complaint', 'verified complaint|nature of the action|preliminary statement|jury trial demanded|demand for a jury trial|complaint.{0,40}(jury trial demanded|demand for a jury)', '03_Litigation/Pleadings', '03_Complaint', 'clear', r"\bcomplaint\b|\bcompl\b", False),
    ('Answer', 'answer and affirmative defenses|answering the (verified )?complaint|answer to the (verified |amended )?complaint', '03_Litigation/Pleadings', '05_Answers', 'clear', r"\banswer\b", False),
    ('Verification', r"\bverification\b.{0,60}(sworn|deposes)|individual verification", '03_Litigation/Pleadings', '03_Complaint', 'proposed', r"\bverification\b", False),
    ('Consent to change attorney', 'consent to change attorney', '03_Litigation/Pleadings', '11_Notices', 'clear', r"consent to change attorney|\bctca\b", False),
    ('Affidavit of service', 'affidavit of service|proof of service|certificate of service|deponent .{0,30}served', '03_Litigation/Pleadings', '04_Service of Process', 'clear', r"(affidavit|affirmation|proof|certificate) of service|\baos\b", False),
    ('Waiver of service', 'waiver of (the )?service of summons', '03_Litigation/Pleadings', '04_Service of Process', 'clear', None, False),
    ('Subpoena', r"\bsubpoena\b", '03_Litigation/Discovery', '07_Discovery', 'clear', r"\bsubpoena\b", False),
    ('Notice of deposition', 'notice (to take|of) deposition|deposition upon oral examination', '03_Litigation/Discovery', '08_Depositions/Notices of Deposition', 'clear', r"\bdeposition\b|\bebt\b", False),
    ('Notice of availability (efiling)', 'notice of availability', '03_Litigation', '11_Notices', 'proposed', 'notice of availability', False),
    ('Notice of entry', 'notice of entry', '03_Litigation/Orders', '11_Notices', 'clear', r"notice of entry|\bnoe\b", False),
    ('Notice of appearance', 'notice of appearance', '03_Litigation', '11_Notices/Notice of Appearance', 'clear', r"notice of appearance|\bnoa\b", False),
    ('Notice of appeal', 'notice of appeal', '03_Litigation', '11_Notices/Notice of Appeal', 'clear', 'notice of appeal', False),
    ('Discontinuance', r"\bdiscontinuance\b|stipulation of discontinuance", '03_Litigation', '11_Notices/Notice of Dismissal', 'proposed', r"\bdiscontinuance\b|\bdisc\b", False),
    ('Notice of dismissal', 'notice of (voluntary )?dismissal', '03_Litigation', '11_Notices/Notice of Dismissal', 'clear', None, False),
    ('Notice of settlement', 'notice of settlement', '03_Litigation', '11_Notices/Notice of Settlement', 'clear', 'notice of settlement', False),
    ('Stipulation of extension of time', 'stipulation .{0,30}extension of time|extend .{0,25}time to (answer|respond)', '03_Litigation', '10_Stipulations/Extension of Time', 'clear', 'stip.{0,20}extension|extension of time', False),
    ('Stipulation of dismissal', r"stipulation of (voluntary )?dismissal|rule 41\s*\(\s*a\s*\)", '03_Litigation', '10_Stipulations/Voluntary Dismissal', 'clear', 'stip.{0,20}dismissal', False),
    ('Stipulation', r"it is hereby stipulated and agreed|\bstipulation\b", '03_Litigation', '10_Stipulations', 'clear', r"\bstip(ulation)?\b", False),
    ('Defendant Rule 26(a)(1)', r"defendant'?s?.{0,25}rule 26\s*\(\s*a\s*\)\s*\(\s*1\s*\)", '03_Litigation/Discovery', '06_Case Management Plan Initial Conference/Rule 26(a)(1)/Defendant Rule 26(a)(1)', 'proposed', None, False),
    ('Rule 26(a)(1) initial disclosures', r"rule 26\s*\(\s*a\s*\)\s*\(\s*1\s*\)|initial disclosures", '03_Litigation/Discovery', '06_Case Management Plan Initial Conference/Rule 26(a)(1)', 'clear', None, False),
    ('Case management plan', 'civil case management plan|case management plan and scheduling order|initial pretrial conference', '03_Litigation', '06_Case Management Plan Initial Conference', 'clear', r"case management|\bcmp\b|initial conference", False),
    ('Discovery deficiency letter', 'deficiency letter|deficien(t|cies) .{0,30}(response|discovery)', '03_Litigation/Discovery', '07_Discovery/Deficiency Letters', 'proposed', None, False),
    ('Expert witness report', r"expert (witness )?report|rule 26\s*\(\s*a\s*\)\s*\(\s*2\s*\)", '03_Litigation/Discovery', '07_Discovery', 'proposed', None, False),
    ('Responses to discovery demands', 'responses? (and objections )?to .{0,35}(demands?|interrogatories|requests? for)', '03_Litigation/Discovery', '07_Discovery', 'clear', None, False),
    ('Discovery demands', r"\binterrogator(y|ies)\b|requests? for (the )?production of documents|notice (to produce|for discovery)|demand for a bill of particulars|requests? for admission", '03_Litigation/Discovery', '07_Discovery', 'clear', r"\bdiscovery\b|interrogator|demand for|bill of particulars", False),
    ('Judgment of foreclosure and sale', 'judgment of foreclosure( and sale)?', '03_Litigation/Orders', '11_Notices', 'clear', r"judgment of foreclosure|\bjfs\b", False),
    ('Order to show cause', r"\border to show cause\b", '03_Litigation/Motions', '09_Motions', 'proposed', r"\bosc\b|show cause", False),
    ('Court order', 'it is (hereby )?ordered|so ordered|decision (and|&) order', '03_Litigation/Orders', '11_Notices', 'proposed', r"\border\b|\bdecision\b", False),
    ('Summary judgment motion', 'summary judgment', '03_Litigation/Motions', '09_Motions', 'clear', r"\bmsj\b|summary judgment", False),
    ('Memorandum of law', 'memorandum of law', '03_Litigation/Motions', '09_Motions', 'clear', r"memorandum of law|\bmol\b", False),
    ('Deposition transcript', 'transcript of .{0,30}(deposition|examination|proceedings)|examination before trial', '03_Litigation/Discovery', '08_Depositions', 'proposed', 'transcript', False),
    ('Notice of motion', 'notice of motion|upon the annexed (affirmation|affidavit)', '03_Litigation/Motions', '09_Motions', 'clear', r"notice of motion|\bmotion\b|\bmsj\b|summary judgment", False),
    ('Closing or title affidavit', r"affidavit of compliance|smoke detector requirement|carbon monoxide (alarm|detector)|real property transfer report|\brp-?5217\b|\btp-?584\b|affidavit of title", '01_General', None, 'clear', r"affidavit of compliance|smoke detector|affidavit of title|\brp-?5217\b|\btp-?584\b", False),
    ('Affirmation in support or opposition', 'affirmation in (support|opposition)|affidavit in (support|opposition)', '03_Litigation/Motions', '09_Motions', 'proposed', r"affirmation|affidavit|\baff\b|\breply\b", False),
    ('Credit report', r"\bcredit report\b|credit (report|file) (disclosure|number)|personal credit report", '01_General', '02_FCRA Dispute/Credit Report', 'clear', 'credit report|experian|transunion|equifax', False),
    ('Dispute letter', r"i am writing to dispute|15 u\.?s\.?c\.?\s*.{0,6}1681|fair credit reporting act|dispute letter", '01_General', '02_FCRA Dispute/Dispute Letters', 'clear', None, False),
    ('Identifying document', r"driver'?s? licen[sc]e|social security (card|number)|\bpassport\b|identification card", '01_General', '02_FCRA Dispute/Identifying Documents', 'proposed', r"licen[sc]e|passport|\bssn\b|social security|\bid card\b", False),
    ('Mortgage, note or ACRIS record', r"\bacris\b|promissory note|note and mortgage|mortgage.{0,40}(recorded|dated)", '01_General', None, 'clear', r"\bacris\b|\bmtge\b|note and mortgage", False),
    ('Mortgage statement', 'mortgage statement|principal balance|escrow (account|balance)|loan number', '02_Loss Mitigation/Mortgage Statements', None, 'clear', 'mortgage (stmt|statement)', False),
    ('Bank statement', 'beginning balance|ending balance|account summary|statement period', '02_Loss Mitigation/Bank Statements', None, 'clear', 'bank (stmt|statement)', False),
    ('Pay stub', r"earnings statement|gross pay|net pay|\bpay ?stub\b|year[- ]to[- ]date", '02_Loss Mitigation/Pay Stubs', None, 'clear', 'pay ?stub|payroll', False),
    ('Tax return or W-2', r"form 1040|individual income tax return|wage and tax statement|\bw-?2\b", '02_Loss Mitigation/Taxes', None, 'clear', r"\b1040\b|\bw-?2\b|tax return", False),
    ('Utility bill', r"con ?edison|national grid|\bpseg\b|water (bill|board)|utility bill|service address", '02_Loss Mitigation/Utility Bills', None, 'clear', r"utility|con ?ed\b|national grid|water bill", False),
    ('Hardship letter or financial worksheet', 'hardship (letter|affidavit)|financial worksheet|request for mortgage assistance|loss mitigation application', '02_Loss Mitigation', None, 'clear', r"hardship|financial worksheet|\brma\b", False),
    ('Ex-parte settlement letter', 'ex[- ]?parte .{0,25}settlement', '01_General', '12_Settlement Documents/Ex-Parte Settlement Letter', 'proposed', None, False),
    ('Itemized damages', 'itemized damages|damages calculation', '01_General', '12_Settlement Documents/Itemized Damages to Defendants', 'proposed', None, False),
    ('Settlement agreement', 'settlement agreement|general release|release and settlement', '01_General', '12_Settlement Documents', 'clear', r"settlement agreement|\brelease\b", False),
    ('Status report', 'status report|joint status letter', '01_General', '13_Status Reports', 'clear', 'status report', False),
    ('Invoice or fees', r"\binvoice\b|billing statement|fee agreement", '01_General', '14_Billing and Invoices', 'clear', 'invoice|billing', False),
    ('Client notes or statement', 'notes from (the )?client|client statement', '01_General', '01_Documents from client', 'proposed', r"notes from client|client statement|case summary|case[ _-]?overview|\btimeline\b|\bchronology\b", False),
    ('Insurance', r"\bhomeowners?\b.{0,20}insurance|force[- ]?placed|hazard insurance|\bdeclarations? page\b|insurance policy", '02_Loss Mitigation', '01_Documents from client', 'proposed', r"\bhoi\b|force[- ]?placed|\bhazard\b|prop\.? ?ins\b|\binsurance\b", False),
    ('Check or payment receipt', r"\bmoney order\b|payment receipt|\bremittance\b", '01_General', '14_Billing and Invoices', 'proposed', r"\bchecks?\b|\breceipts?\b|money order", False),
    ('Tax lien', r"\btax lien\b|notice of federal tax lien", '01_General', None, 'clear', 'tax lien', False),
    ('Retainer', 'retainer agreement|attorney[- ]client (agreement|retainer)', '01_General', '01_Documents from client', 'clear', 'retainer', False),
    ('Deed or title', r"\b(bargain and sale|quitclaim|warranty) deed\b|grantor.{0,25}grantee", '01_General', None, 'clear', r"\bdeed\b", False),
    ('Email', r"^\s*(from|subject)\s*:", '04_Correspondence', None, 'clear', r"\.msg$|^re[: ]|^fwd?[: ]", True),
    ('Servicer correspondence', r"\b(newrez|shellpoint|ocwen|nationstar|mr\.? cooper|select portfolio|specialized loan servicing|rushmore|carrington|loancare|cenlar|flagstar|freedom mortgage|fay servicing|roundpoint)\b", '04_Correspondence', None, 'proposed', None, False),
    ('Letter', r"^\s*dear\b|\bsincerely,|very truly yours", '04_Correspondence', None, 'proposed', r"\bletter\b|\bltr\b|correspondence", True),
]

#: What a document of each type does.
DESCRIPTIONS = {
    'Response to PMC letter': "Plaintiff answers the defendant's pre-motion conference letter, arguing why the proposed motion to dismiss should not be allowed.",
    'Pre-motion conference letter': 'Defendant asks the judge for permission to file a motion to dismiss and outlines the grounds.',
    'Opposition to motion to dismiss': 'Plaintiff argues against the motion to dismiss and asks the court to let the case proceed.',
    'Rule 12 motion to dismiss': 'Defendant asks the court to throw out the complaint before answering it.',
    'Pro hac vice motion': 'An out-of-state attorney asks to be admitted to appear in this one case.',
    'Adjournment request': 'A party asks the court to push back a deadline or a scheduled appearance.',
    'Amended complaint': 'A corrected or expanded version of the complaint that replaces the original.',
    'Summons and complaint': 'The paper that starts the lawsuit: it notifies the defendant and states the claims.',
    'Request for preliminary conference': 'A party asks the state court to schedule the first conference and set the discovery calendar.',
    'Complaint': 'States the claims and the facts the plaintiff intends to prove.',
    'Answer': "The defendant's formal response to the complaint, admitting or denying each allegation and raising defenses.",
    'Verification': 'A sworn statement confirming the truth of a pleading. It travels attached to the pleading it verifies.',
    'Consent to change attorney': 'Records that the client is changing counsel and who now represents them.',
    'Affidavit of service': 'Sworn proof that a paper was delivered to the other side, and how.',
    'Waiver of service': 'The defendant agrees to accept the summons without formal service.',
    'Subpoena': 'Orders a person or company to produce documents or appear to testify.',
    'Notice of deposition': 'Tells the other side when and where a witness will be examined under oath.',
    'Notice of availability (efiling)': 'A NYSCEF housekeeping notice that a document is available in the electronic file.',
    'Notice of entry': 'Notifies the parties that the court has entered an order, which starts the appeal clock.',
    'Notice of appearance': 'An attorney tells the court and the parties that they now represent someone in the case.',
    'Notice of appeal': 'Starts an appeal of a decision to a higher court.',
    'Discontinuance': 'Ends the case, or ends it as to one party, without a trial.',
    'Notice of dismissal': 'Notifies that the case, or a claim in it, has been dismissed.',
    'Notice of settlement': 'Notifies the court and the parties that the matter has been settled.',
    'Stipulation of extension of time': 'Both sides agree to give a party more time to answer or respond.',
    'Stipulation of dismissal': 'Both sides agree to end the case, usually as part of a settlement.',
    'Stipulation': 'A written agreement between the parties on a procedural point, filed with the court.',
    'Defendant Rule 26(a)(1)': "The defendant's initial disclosures: witnesses, documents and damages it may rely on.",
    'Rule 26(a)(1) initial disclosures': 'The required opening exchange of witnesses, documents and damages before discovery begins.',
    'Case management plan': 'The schedule the court sets for discovery, motions and trial.',
    'Discovery deficiency letter': 'One side tells the other that its discovery responses are incomplete and demands the rest.',
    'Expert witness report': "An expert's written opinion and the basis for it, exchanged before trial.",
    'Responses to discovery demands': "Answers and objections to the other side's document requests or interrogatories.",
    'Discovery demands': 'Requests for documents, written questions or admissions directed at the other side.',
    'Judgment of foreclosure and sale': "The court's decision allowing the property to be sold to satisfy the mortgage debt.",
    'Order to show cause': 'An urgent application asking the judge to order the other side to justify why relief should not be granted.',
    'Court order': "The judge's ruling on an application, and what the parties must now do.",
    'Summary judgment motion': 'Asks the court to decide the case, or part of it, without a trial because the facts are not in dispute.',
    'Memorandum of law': 'The legal argument supporting or opposing a motion, with the authorities relied on.',
    'Deposition transcript': 'The word-for-word record of a witness examined under oath.',
    'Notice of motion': 'The cover paper that formally puts a motion before the court and states the relief sought.',
    'Closing or title affidavit': 'A sworn statement given at a property closing, such as compliance with the smoke detector requirement.',
    'Affirmation in support or opposition': "An attorney's sworn statement of the facts backing or opposing a motion.",
    'Credit report': 'The consumer file held by a credit bureau, and the entries the dispute is about.',
    'Dispute letter': 'The consumer tells a bureau or furnisher that an entry is wrong and asks for it to be corrected.',
    'Identifying document': 'Proof of identity supplied by the client, such as a licence, passport or social security card.',
    'Mortgage, note or ACRIS record': 'The loan instrument itself or its recorded copy. In a foreclosure it is the central piece of evidence.',
    'Mortgage statement': "The servicer's periodic statement of what is owed on the loan.",
    'Bank statement': "The client's account activity, used to document income and hardship.",
    'Pay stub': "Proof of the client's earnings, used in a loss mitigation package.",
    'Tax return or W-2': "The client's declared income, used in a loss mitigation package.",
    'Utility bill': 'A household bill, used to document occupancy or expenses.',
    'Hardship letter or financial worksheet': "The client's account of why they fell behind and what they can afford to pay.",
    'Ex-parte settlement letter': 'A settlement communication addressed to the court outside the presence of the other side.',
    'Itemized damages': 'A breakdown of the amounts being claimed and how each was calculated.',
    'Settlement agreement': 'The terms on which the parties agree to end the dispute, and the releases given.',
    'Status report': 'An update to the court on where the case stands.',
    'Invoice or fees': 'A bill for legal work or a statement of fees and costs.',
    'Client notes or statement': "The client's own account of the facts, or the firm's notes of it.",
    'Check or payment receipt': 'Evidence that a payment was made, and of how much.',
    'Tax lien': 'A recorded claim by a tax authority against the property.',
    'Retainer': 'The engagement agreement: it names the client and states what the firm was hired to do.',
    'Deed or title': 'The instrument transferring or evidencing ownership of the property.',
    'Email': 'Correspondence exchanged by email.',
    'Servicer correspondence': 'A letter from the loan servicer about the account, such as a reinstatement quote or a default notice.',
    'Letter': 'General correspondence on the matter.',
}
