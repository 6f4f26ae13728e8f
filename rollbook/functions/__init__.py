"""Column functions of the register: codes, postcodes, dates, names, keys."""
