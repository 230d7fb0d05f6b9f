"""Domain values shared by the operators."""

# Event types, default category, segment names (in the order
# the classification tests them) and the top-products text layout.
VIEW = "view"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"
FUNNEL_TYPES = (VIEW, ADD_TO_CART, PURCHASE)

UNKNOWN_CATEGORY = "UNKNOWN"

BUYER = "Buyer"
CART_ABANDONER = "Cart_Abandoner"
WINDOW_SHOPPER = "Window_Shopper"
UNKNOWN_SEGMENT = "Unknown"

RULE = "=" * 60
TITLE_FORMAT = "TOP %d MOST VIEWED PRODUCTS - %s"
PRODUCT_LINE_FORMAT = "%d. Product ID: %s"
CATEGORY_LINE_FORMAT = "   Category: %s"
VIEWS_LINE_FORMAT = "   Views: %d"
