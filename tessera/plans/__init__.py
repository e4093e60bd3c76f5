"""Views of the tables as records of a review, and the queries over them."""
