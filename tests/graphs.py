"""Edges of the graphs that the tests use."""

SHOP_EDGES = (("Shopping_Event", "Ad_Spend"), ("Shopping_Event", "Page_Views"), ("Ad_Spend", "Page_Views"),
              ("Shopping_Event", "Unit_Price"), ("Page_Views", "Sold_Units"), ("Unit_Price", "Sold_Units"),
              ("Shopping_Event", "Sold_Units"), ("Sold_Units", "Revenue"), ("Unit_Price", "Revenue"),
              ("Ad_Spend", "Operational_Cost"), ("Sold_Units", "Operational_Cost"), ("Revenue", "Profit"),
              ("Operational_Cost", "Profit"))

SERVICE_EDGES = (("Product_DB", "Caching_Service"), ("Shipping_Cost_Service", "Product_Service"),
                 ("Caching_Service", "Product_Service"), ("Customer_DB", "Product_Service"),
                 ("Customer_DB", "Auth_Service"), ("Order_DB", "Order_Service"), ("Customer_DB", "API"),
                 ("Product_Service", "API"), ("Auth_Service", "API"), ("Order_Service", "API"),
                 ("Auth_Service", "www"), ("API", "www"), ("www", "Website"))

SUPPLY_EDGES = (("demand", "submitted"), ("constraint", "submitted"), ("submitted", "confirmed"),
                ("confirmed", "received"))
