from .applicants import applicant_age, applicant_base, applicant_label, applicant_label_nulls, applicant_rare
from .balances import (
    instalment_base,
    instalment_status,
    instalments_per_loan,
    instalments_two_level,
    instalments_with_pos,
    pos_base,
    pos_flat,
    pos_per_loan,
    pos_two_level,
)
from .bureau import (
    bureau_base,
    bureau_behaviour,
    bureau_filled,
    bureau_filled_with_behaviour,
    bureau_ratios,
    bureau_score,
    bureau_skew,
    credit_status_score,
)
from .cards import card_base, card_behaviour, card_means, card_nulled
from .previous import (
    application_history,
    previous_base,
    previous_capped,
    previous_drop_first,
    previous_last,
    previous_regrouped,
)
from .wide import prune, wide_age, wide_base, wide_nested, wide_rare, wide_ratios

__all__ = [n for n in dir() if not n.startswith("_")]
