"""jobnest.operators: ``DataFrame -> DataFrame`` operators (use with ``df.transform``).

vacancies      P1-P9 document projection with validity flags; X1 page abort, X2 quarantine, W1
trees          G1 arbitrary-depth tree flatten and pre-order; F4 roots / parents; P11
metro          G2 / G3 fixed-depth explodes; A1 distinct before the cast; E3 / E4; O1 / O2
dictionaries   G5 object keys; G6 json_normalize-style dotted columns
employers      A4 / J4 id sets; B1 / F3 / E12 batches; J2 / E5 lookup; P10 projection
requests       S2 / S9 / J3 / F1 / A2 / G4 / L1 / F6 / G7 / J1 search planning and list pages
indexing       exact, skew-safe, contiguous row numbering (for B1, L1 and pre-order)
clean          C1 generic raw -> clean; C2 clean_areas
"""
