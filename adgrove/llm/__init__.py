"""Operations for preparing training data: one module per operator, their registered queries in ``queries``."""
